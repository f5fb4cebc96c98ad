"""Structure files to tables of chains, residues and atoms, in one pass over their bytes."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a task hands over at once, whatever the size of a file.
ROWS = 20_000
FIELDS = ["kind", "path", "idx", "name", "atom_idx", "atom_num", "res_idx", "res_num", "x", "y", "z", "present", "error"]
TAGGED = "kind string, path string, idx long, name string, atom_idx long, atom_num long, res_idx long, res_num long, x double, y double, z double, present boolean, error string"
KINDS = [pa.string(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 4, *[pa.float64()] * 3, pa.bool_(), pa.string()]


def coordinates(arrays) -> np.ndarray:
    """Those of the first model of an ensemble, if they are as many as the atoms; else the atoms' own."""
    own = arrays["atoms"]["coords"]
    if "ensemble" in arrays and "coords" in arrays and len(arrays["ensemble"]) and len(arrays["coords"]):
        first = arrays["ensemble"][0]
        start, count = int(first["atom_coord_idx"]), int(first["atom_num"])
        model = arrays["coords"]["coords"][start : start + count]
        if len(model) == len(own):
            return model
    return own


def _columns(kind: str, path: str, lo: int, n: int, **given) -> pa.RecordBatch:
    cols = {"kind": [kind] * n, "path": [path] * n, "idx": np.arange(lo, lo + n), **given}
    return pa.RecordBatch.from_arrays([pa.array(cols[f], t) if f in cols else pa.nulls(n, t) for f, t in zip(FIELDS, KINDS)], FIELDS)


def _rows(path: str, content: bytes):
    with np.load(io.BytesIO(content), allow_pickle=False) as arrays:
        chains, residues, atoms = arrays["chains"], arrays["residues"], arrays["atoms"]
        xyz = np.asarray(coordinates(arrays), float).reshape(-1, 3)
    offsets = ("atom_idx", "atom_num", "res_idx", "res_num")
    for kind, rows, fields in (("chain", chains, offsets), ("residue", residues, offsets[:2])):
        for lo in range(0, len(rows), ROWS):
            part = rows[lo : lo + ROWS]
            yield _columns(kind, path, lo, len(part), name=part["name"].astype(str).tolist(), present=part["present"].astype(bool), **{f: part[f].astype(np.int64) for f in fields})
    for lo in range(0, len(atoms), ROWS):
        part, at = atoms[lo : lo + ROWS], xyz[lo : lo + ROWS]
        yield _columns("atom", path, lo, len(part), name=part["name"].astype(str).tolist(), present=part["present"].astype(bool), x=at[:, 0], y=at[:, 1], z=at[:, 2])


def structure_rows(files: DataFrame) -> DataFrame:
    """Tagged rows of structure files, from rows (path, content) as ``binaryFile`` gives them.

    A file is an NPZ of record arrays: chains (name, present, atom_idx, atom_num, res_idx, res_num),
    residues (name, present, atom_idx, atom_num), atoms (name, present, coords) and, if it has an
    ensemble, ensemble (atom_coord_idx, atom_num) and coords (coords). Fields are taken by name. A
    file that cannot be read is one row of kind ``error``; a null content is such a file. A task holds
    one file and ROWS rows.
    """

    def read(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    yield from _rows(path, content.as_py() if content.is_valid else b"")
                except (ValueError, KeyError, OSError, EOFError, IndexError) as e:
                    yield _columns("error", path, 0, 1, error=[f"{type(e).__name__}: {e}"[:200]])

    return files.select("path", "content").mapInArrow(read, TAGGED)


def write_structures(files: DataFrame, path: str) -> dict[str, DataFrame]:
    """Reads the files once and writes their rows below ``path``, a folder a kind; gives chains, residues,
    atoms and errors back as tables of it. Rows of large files are dealt anew by (file, kind and block of
    rows), so that no writer has a whole one. An error in the middle of a file leaves the rows before it."""
    tagged = structure_rows(files)
    dealt = tagged.repartition("path", "kind", F.floor(F.col("idx") / ROWS))
    dealt.write.partitionBy("kind").parquet(path)
    spark = files.sparkSession
    # the kinds' folders exist only where there are rows: the schema is given
    rows = spark.read.schema(TAGGED).parquet(path)
    of = lambda kind, *cols: rows.where(F.col("kind") == kind).select("path", *cols)
    return {
        "chains": of("chain", "idx", "name", "present", "atom_idx", "atom_num", "res_idx", "res_num"),
        "residues": of("residue", "idx", "name", "present", "atom_idx", "atom_num"),
        "atoms": of("atom", "idx", "name", "present", "x", "y", "z"),
        "errors": of("error", "error"),
    }
