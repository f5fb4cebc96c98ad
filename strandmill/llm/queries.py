"""The operators' queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import language_id, toxicity
from .common import table
from .decontamination import find_leaks
from .exact_dedup import exact_dedup
from .fill_middle import fill_in_middle, restored
from .html_extract import html_extract
from .license_scan import license_scan
from .line_dedup import line_dedup
from .mixing import DIGESTS, plan_mix
from .ngram_join import ngram_join
from .packing import best_fit_packing
from .secret_scan import secret_scan
from .token_alignment import token_alignment


def op1_license_scan(spark, sf_dir):
    out = license_scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = language_id.held_out("doc_id")
    out = language_id.predict(docs, language_id.train(docs.where(~held)))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


def op3_line_dedup(spark, sf_dir):
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op4_decontamination(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_ngram_join(spark, sf_dir):
    return ngram_join(table(spark, sf_dir, "documents"))


def op6_html_extract(spark, sf_dir):
    return html_extract(table(spark, sf_dir, "pages"))


def op7_exact_dedup(spark, sf_dir):
    out = exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_packing(spark, sf_dir):
    return best_fit_packing(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark, sf_dir):
    out = secret_scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op10_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = toxicity.held_out("doc_id")
    model = toxicity.train(docs.where(~held), labels.where(~held))
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted", F.size("offending").alias("n_offending"))


def op11_mixing(spark, sf_dir):
    rows = plan_mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def op12_fill_middle(spark, sf_dir):
    rows = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op13_token_alignment(spark, sf_dir):
    return token_alignment(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_language_id, op3_line_dedup, op4_decontamination, op5_ngram_join, op6_html_extract, op7_exact_dedup, op8_packing, op9_secret_scan, op10_toxicity, op11_mixing, op12_fill_middle, op13_token_alignment)}

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"
ORACLE_SQL = {
    "op7_exact_dedup": f"""
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM (SELECT doc_id, {_NORM} AS norm FROM documents)
        WINDOW w AS (PARTITION BY norm)""",
    "op11_mixing": rf"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
        s AS (SELECT source, sum(size)::bigint AS source_size, ([3.0, 1.0, 2.0]::double[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
        -- the sources whose limit is reached first, one after another: the level is highest where it is right
        r AS (SELECT *, row_number() OVER o AS k, sum(2 * source_size) OVER o - 2 * source_size AS full_before, sum(w) OVER o - w AS w_before,
                     1.5 * sum(source_size) OVER () AS mix, sum(w) OVER () AS w_all
              FROM s WINDOW o AS (ORDER BY source_size / w, source ROWS UNBOUNDED PRECEDING)),
        v AS (SELECT arg_max(struct_pack(rest := mix - full_before, w := w_all - w_before), (mix - full_before) / (w_all - w_before)) AS level FROM r),
        t AS (SELECT source, source_size, least(2.0 * source_size, w * level.rest::double / level.w) AS target FROM s, v),
        c AS (SELECT doc_id, source, size, source_size, target, draw, floor(rate) + (u < rate - floor(rate))::int AS copies
              FROM (SELECT doc_id, d.source, size, source_size, target, draw, coalesce(target / nullif(source_size, 0), 0) AS rate,
                           ('0x' || substr(md5('11:' || (draw // 4) || ':' || coalesce(doc_id::varchar, '')), (draw % 4) * 8 + 1, 8))::bigint / 4294967296.0 AS u
                    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, range({4 * DIGESTS}) g(draw))),
        best AS (SELECT source, arg_min(draw, (away, draw)) AS draw FROM (SELECT source, draw, abs(sum(size * copies) - any_value(target)) AS away FROM c GROUP BY 1, 2) GROUP BY 1)
        SELECT doc_id, size, source_size, target, (size * copies)::bigint AS taken FROM c JOIN best ON c.source IS NOT DISTINCT FROM best.source AND c.draw = best.draw""",
    "op12_fill_middle": """
        WITH h AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS s FROM documents),
        c AS (SELECT *, ('0x' || s[1:8])::bigint % (n + 1) AS a, ('0x' || s[9:16])::bigint % (n + 1) AS b,
                     CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || s[17:24])::bigint % 100 >= 90 THEN 'plain'
                          WHEN ('0x' || s[25:32])::bigint % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
        p AS (SELECT *, substr(t, 1, least(a, b)) AS pre, substr(t, least(a, b) + 1, abs(a - b)) AS mid, substr(t, greatest(a, b) + 1) AS suf FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(pre || mid || suf) AS restored_sha256
        FROM p""",
}
