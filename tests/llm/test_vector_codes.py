"""Codes of vectors against a plain version; odd rows."""

import hashlib
import math
import random

import duckdb
import pytest

from lexweave.llm import code_books, queries

SHAPE = "vec_id long, embedding array<double>, label int, part string, n int, code int"


def plain(rows, parts=16, entries=64, rounds=2):
    kept = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][2]) // parts
    cut = [[tuple(q[p * width : (p + 1) * width]) for p in range(parts)] for _, _, q in kept]
    first = sorted(range(len(kept)), key=lambda k: kept[k][0])[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - c) ** 2 for a, c in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [tuple(sum(c) // len(groups[j]) for c in zip(*groups[j])) if j in groups else e for j, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], {}
    for (i, lab, _), c in zip(kept, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        error = sum(f[0] for f in found)
        by_label[lab] = by_label.get(lab, 0) + error
        out.append((i, "".join(f"{f[1]:02x}" for f in found), error, lab))
    return sorted((i, c, e, by_label[lab], digest) for i, c, e, lab in out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SHAPE)


@pytest.mark.parametrize("large", [1e4, 1e5, 3e9, 1e300])
def test_equals_a_plain_version(spark, large):
    """Negative floors, ties, repeated rows, null labels, rows that take no part; integers within and beyond 24 bits."""
    rng = random.Random(1)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.1, -0.013, 3.0, large if i in (7, 200) else 0.0]) for _ in range(32)], rng.choice([1, 2, None])) for i in range(250)]
    rows += [(500 + i, rows[9][1], 3) for i in range(120)]
    rows += [(1000, None, 1), (1001, [math.nan] * 32, 2), (1002, [None] * 32, 2), (1003, [math.inf] * 32, 2)]
    want = [(i, c, e if e < 1 << 63 else None, s if s < 1 << 63 else None, d) for i, c, e, s, d in plain(rows)]
    assert sorted(map(tuple, code_books.compressed(frame(spark, rows)).collect())) == want


def test_components_that_leave_doubles(spark):
    rows = [(0, [0.0] * 16, 1), (1, [1e306] * 16, 2), (2, [-1e306] * 16, 2)]
    got = {r["vec_id"]: r for r in code_books.compressed(frame(spark, rows)).collect()}
    assert [got[i]["code"][:2] for i in range(3)] == ["00", "01", "02"] and all(r["error"] == r["label_error"] == 0 for r in got.values())


def test_odd_tables(spark):
    assert code_books.compressed(frame(spark, []).limit(0)).count() == 0
    rows = [(1, [0.5] * 32, 1), (1, [0.25] * 32, 1), (None, [0.5] * 32, None), (2, [1.0] * 16, 1), (3, [1.0] * 5, 4), (4, [], 1)]
    got = sorted(map(tuple, code_books.compressed(frame(spark, rows)).select("vec_id", "code", "error", "label_error").collect()), key=str)
    entry = lambda j: f"{j:02x}" * 16
    want = [(1, entry(0), 0, 0), (1, entry(1), 0, 0), (None, entry(1), 0, 0), (2, None, None, 0), (3, None, None, 0), (4, None, None, 0)]
    assert got == sorted(want, key=str)
    assert code_books.compressed(frame(spark, [(1, [], 1)])).first()["code"] == "00" * 16


def test_given_table_by_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got = queries.op12_vector_codes(spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(queries.SQL["op12_vector_codes"]).fetchall())
