"""Near-duplicate vectors by inverted lists and product quantisation (operator 9).

Unit vectors lie in the lists of their nearest coarse centroids; their
residuals are coded by the nearest codeword in each of several subspaces. In
large tables a centroid is a coarse one plus one of a shared set of fine ones,
so lists grow in number with the rows while what is fitted stays bounded. A
vector visits the lists of its `probes` nearest centroids. What travels to a
list are codes of its members and, of visitors, components rounded to 8 bits:
per visitor, a table of its squared distances to all codewords gives by lookups
its distance to each coded member, and whoever comes within the radius of the
cosine plus both coding errors is marked, which loses no pair (triangle
inequality). Only the marked ones' vectors are then fetched to the list, and
their pairs decided by exact cosine. Centroids and codewords are fitted on a
bounded sample, thinned so that a group of copies counts once; every row is
indexed and every row searches. Each length of vectors has its own quantiser;
the few of a rare length all meet each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from lexweave.llm.common import components, discard, staged

FOUND = "id long, n long, root long"


@dataclass
class Quantiser:
    coarse: np.ndarray  # centroids x dims
    fine: np.ndarray  # offsets from them x dims; lists are all pairs of both
    codewords: np.ndarray  # subspaces x words x dims / subspaces
    probes: int

    def centre(self, at: np.ndarray | int) -> np.ndarray:
        return self.coarse[at // len(self.fine)] + self.fine[at % len(self.fine)]

    def nearest(self, unit: np.ndarray) -> np.ndarray:
        """The probed lists of each vector, nearest first: of the nearest coarse centroids all fine ones."""
        d = (self.coarse**2).sum(1) - 2 * unit @ self.coarse.T
        near = first(d, self.probes)
        if len(self.fine) == 1:
            return near
        far = np.take_along_axis(d, near, 1)
        to = self.fine @ self.coarse.T  # what fine and coarse have in common
        d = far[:, :, None] + 2 * to.T[near] - 2 * (unit @ self.fine.T)[:, None, :] + (self.fine**2).sum(1)
        lists = (near[:, :, None] * len(self.fine) + np.arange(len(self.fine))).reshape(len(unit), -1)
        return np.take_along_axis(lists, first(d.reshape(len(unit), -1), self.probes), 1)

    def code(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals, and the distances from what they stand for."""
        m, _, width = self.codewords.shape
        parts = residual.reshape(len(residual), m, width)
        table = self.table(residual)
        codes = table.argmin(2)
        coded = self.codewords[np.arange(m), codes]
        return codes.astype(np.uint8), np.sqrt(((parts - coded) ** 2).sum((1, 2)))

    def table(self, residual: np.ndarray) -> np.ndarray:
        """Squared distances of each residual's parts to all codewords."""
        m, _, width = self.codewords.shape
        parts = residual.reshape(len(residual), m, width)
        cross = np.einsum("nmw,mkw->nmk", parts, self.codewords, optimize=True)
        return (parts**2).sum(2)[:, :, None] - 2 * cross + (self.codewords**2).sum(2)


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    k = min(k, len(x))
    centres = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def thinned(unit: np.ndarray, cosine: float) -> np.ndarray:
    """Vectors of which no two are as close as cosine, the first of each group."""
    kept = np.empty((0, unit.shape[1]))
    for x in np.array_split(unit, max(1, len(unit) // 256)):
        x = x[(x @ kept.T).max(1, initial=-1) < cosine]
        own: list[int] = []
        close = x @ x.T >= cosine
        for i in range(len(x)):
            if not close[i, own].any():
                own.append(i)
        kept = np.concatenate([kept, x[own]])
    return kept


def first(d: np.ndarray, k: int) -> np.ndarray:
    """The places of the k least of each row, least first."""
    if k >= d.shape[1]:
        return np.argsort(d, 1, kind="stable")
    some = np.argpartition(d, k - 1, 1)[:, :k]
    return np.take_along_axis(some, np.argsort(np.take_along_axis(d, some, 1), 1, kind="stable"), 1)


def fit(unit: np.ndarray, lists: int, probes: int, cosine: float, most: int = 512, subspaces: int = 16, words: int = 64) -> Quantiser:
    """Lists beyond `most` come from fine centroids, `most` of them at most."""
    some = thinned(unit, cosine - 0.05)
    coarse = k_means(some, min(lists, most))
    subspaces = max(k for k in (1, 2, 4, 8, subspaces) if unit.shape[1] % k == 0)
    residual = some - coarse[((coarse**2).sum(1) - 2 * some @ coarse.T).argmin(1)]
    fine = np.zeros((1, unit.shape[1]))
    if lists >= 2 * most:
        fine = k_means(residual, min(lists // most, most))
        residual = residual - fine[((fine**2).sum(1) - 2 * residual @ fine.T).argmin(1)]
    parts = residual.reshape(len(some), subspaces, -1)
    books = [k_means(parts[:, m], words) for m in range(subspaces)]
    return Quantiser(coarse, fine, np.stack(books), min(probes, len(coarse)))


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their greatest component near 1: no digit changes, and squares neither vanish nor overflow."""
    v = v.astype(float)
    return np.ldexp(v, -np.frexp(np.abs(v).max(1))[1][:, None])


def probes_for(n: int, probes: int) -> int:
    """More lists are probed as they become more: beyond 65,536 vectors three for each doubling."""
    return probes + 3 * max(0, (n - 1 >> 16).bit_length())


def rounded(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components as 8-bit multiples of a step for each vector, the steps, and the distances from what they stand for."""
    step = np.abs(unit).max(1) / 127
    near = np.rint(unit / step[:, None]).astype(np.int8)
    return near, step, np.linalg.norm(unit - near * step[:, None], axis=1)


def marked(q: Quantiser, home: int, visitors: dict[str, np.ndarray], members: dict[str, np.ndarray], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Which visitors and which members of a list may have a pair here, by table lookups."""
    radius = np.sqrt(2 - 2 * cosine) + 1e-4  # for sums in single precision
    hit_v, hit_m = np.zeros(len(visitors["id"]), bool), np.zeros(len(members["id"]), bool)
    for start in range(0, len(hit_v), 512):
        part = slice(start, start + 512)
        table = np.ascontiguousarray(q.table(visitors["unit"][part] - q.centre(home)).transpose(1, 2, 0), np.float32)
        near = table[0][members["codes"][:, 0]]
        for m in range(1, len(table)):
            near += table[m][members["codes"][:, m]]
        close = near <= ((radius + members["error"])[:, None] + visitors["error"][None, part]) ** 2
        i, j = np.nonzero(close)
        other = members["id"][i] != visitors["id"][part][j]
        hit_m[i[other]] = True
        hit_v[start + j[other]] = True
    return hit_v, hit_m


def forest(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """Of nodes linked by pairs (a, b) the smallest node that each reaches."""
    label = np.arange(nodes)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def search(q: Quantiser, home: int, queries: dict[str, np.ndarray], members: dict[str, np.ndarray], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links counted for (ids, numbers) and spanning edges of what a list's members have with its visitors.

    A pair is found from either end whose probes have the other's list. So
    that it counts once for both, a visitor counts all pairs found here; a
    member counts those whose visitor's list it doesn't probe itself.
    """
    radius = np.sqrt(2 - 2 * cosine)
    centre = q.centre(home)
    codes, error = q.code(members["unit"] - centre)
    limit = (radius + error + 1e-9) ** 2
    ids = [queries["id"], members["id"]]
    every, place = np.unique(np.concatenate(ids), return_inverse=True)
    q_place, m_place = place[: len(ids[0])], place[len(ids[0]) :]
    links = np.zeros(len(every), np.int64)
    label = np.arange(len(every))
    for start in range(0, len(queries["id"]), 512):
        part = slice(start, start + 512)
        table = q.table(queries["unit"][part] - centre)
        near = np.zeros((table.shape[0], len(codes)))
        for m in range(table.shape[1]):
            near += table[:, m][:, codes[:, m]]
        i, j = np.nonzero(near <= limit)
        i += start
        keep = queries["id"][i] != members["id"][j]
        i, j = i[keep], j[keep]
        for cut_at in range(0, len(i), 1 << 18):
            a, b = i[cut_at : cut_at + (1 << 18)], j[cut_at : cut_at + (1 << 18)]
            x, y = queries["raw"][a], members["raw"][b]
            exact = np.einsum("nd,nd->n", x, y) >= cosine * queries["norm"][a] * members["norm"][b]
            a, b = a[exact], b[exact]
            links += np.bincount(q_place[a], minlength=len(every))
            alone = ~(members["probes"][b] == queries["home"][a][:, None]).any(1)
            links += np.bincount(m_place[b[alone]], minlength=len(every))
            new = forest(q_place[a], m_place[b], len(every))
            own = np.arange(len(every))
            moved, held = np.flatnonzero(new != own), np.flatnonzero(label != own)
            label = forest(np.concatenate([moved, held]), np.concatenate([new[moved], label[held]]), len(every))
    counted, tied = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(every)))
    return np.stack([every[counted], links[counted]], 1), np.stack([every[tied], every[label[tied]]], 1)


def exact(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links counted and spanning edges of a few vectors of one length, as (id, n, root)."""
    x = scaled(np.stack(rows["v"].to_numpy()))
    norm = np.linalg.norm(x, axis=1)
    every, place = np.unique(rows["id"].to_numpy(), return_inverse=True)
    close = (x @ x.T >= cosine * np.outer(norm, norm)) & (place[:, None] != place)
    label = forest(*(place[k] for k in np.nonzero(close)), len(every))
    tied = np.flatnonzero(label != np.arange(len(every)))
    links = np.bincount(place, close.sum(1), len(every)).astype(np.int64)
    root = pd.array([None] * len(every) + every[label[tied]].tolist(), "Int64")
    return pd.DataFrame({"id": np.concatenate([every, every[tied]]), "n": np.concatenate([links, np.zeros(len(tied), np.int64)]), "root": root})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95, probes: int = 8, per_list: int = 200, sample: int = 8192, block: int = 512, block_visitors: int = 1024, few: int = 256) -> DataFrame:
    """Rows (id, n_links, component_id, kept), one for each input row.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing; others link with those of their own length, lengths of
    at most `few` vectors by exact cosines of all pairs. Rows that repeat an id
    don't link with each other; each has the links of all of them and their
    one component. A null id gets a row without links and without component.
    Large lists are cut into blocks of members and of visitors that meet
    pairwise; from a block leave only marks, and then counts and a spanning
    forest of its links. An empty table gives no rows.
    """
    raw = staged(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.monotonically_increasing_id().alias("row")))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    fine = raw.where("id is not null and v is not null").where(~bad).where(F.exists("v", lambda x: x != 0))
    everything = raw.select(F.col("id").alias("node"))
    sizes = {r["dims"]: r["n"] for r in fine.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy("dims").collect()}
    if not sizes:
        return everything.select(F.col("node").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("node").alias("component_id"), F.col("node").isNotNull().alias("kept"))
    many = [dims for dims, n in sizes.items() if n > few]
    used: list[DataFrame] = []
    parts = [_searched(used, fine.where(F.size("v") == dims), sizes[dims], cosine, probes, per_list, sample, block, block_visitors) for dims in many]
    if len(many) < len(sizes):
        rare = fine.where(~F.size("v").isin(many)).groupBy(F.size("v").alias("dims"))
        parts.append(rare.applyInPandas(lambda rows: exact(rows, cosine), FOUND))
    found = staged(reduce(DataFrame.unionByName, parts))
    discard(*used)
    links = found.where("root is null").groupBy("id").agg(F.sum("n").alias("n_links"))
    tied = components(found.where("root is not null").select(F.col("id").alias("a"), F.col("root").alias("b")))
    out = everything.join(links, everything.node == links.id, "left").drop("id").withColumnRenamed("node", "vec").join(tied, F.col("vec") == F.col("node"), "left")
    component = F.coalesce("component", "vec")
    return out.select(F.col("vec").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec") == component, F.lit(False)).alias("kept"))


def _searched(used: list[DataFrame], fine: DataFrame, n: int, cosine: float, probes: int, per_list: int, sample: int, block: int, block_visitors: int) -> DataFrame:
    """Rows (id, n, root) of the links of n vectors of one length: counts, where root is null, and spanning edges. `used` gets the tables that they are computed from."""
    share = min(1 << 40, (sample << 40) // n + 1)
    drawn = [np.array(r["v"]) for r in fine.where(F.pmod(F.xxhash64("id", "v", F.lit("centroids")), F.lit(1 << 40)) < share).select("id", "v").distinct().orderBy("id", "v").select("v").collect()]
    if not drawn:
        drawn = [np.array(r["v"]) for r in fine.orderBy("id", "v").limit(1).select("v").collect()]
    unit = scaled(np.stack(drawn))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    most = max(1, sample // 16)
    sent = fine.sparkSession.sparkContext.broadcast(fit(unit, min(max(1, n // per_list), most * most), probes_for(n, probes), cosine, most))

    def held(df: DataFrame) -> DataFrame:
        used.append(staged(df))
        return used[-1]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q = sent.value
        for b in batches:
            if len(b):
                x = scaled(np.stack(b["v"].to_numpy()))
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                probed = q.nearest(x).astype(np.int32)
                codes, error = q.code(x - q.centre(probed[:, 0]))
                near, step, off = rounded(x)
                yield pd.DataFrame({"id": b["id"], "row": b["row"], "probes": list(probed), "codes": [c.tobytes() for c in codes], "error": error, "near": [r.tobytes() for r in near], "step": step, "off": off})

    placed = held(fine.mapInPandas(assign, "id long, row long, probes array<int>, codes binary, error double, near binary, step double, off double"))

    def met(visits: DataFrame, homes: DataFrame, own: list[str], theirs: list[str]) -> GroupedData:
        """Visits (row, list, ...) and members (row, list, ...) in blocks, each block of visitors with each block of members of a list."""
        count = lambda df, name, size: df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
        blocks = held(count(visits, "v_blocks", block_visitors).join(count(homes, "m_blocks", block), "list"))
        deal = lambda name, mine: F.pmod(F.xxhash64("id", "row", F.lit(name)), F.col(mine)).cast("int")
        copies = lambda other: F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        none = lambda df, names: [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in names]
        v = visits.join(blocks, "list").select("list", copies("m_blocks").alias("i"), deal("visitor", "v_blocks").alias("j"), F.lit(True).alias("visits"), "id", "row", *own, *none(homes, [c for c in theirs if c not in own]))
        m = homes.join(blocks, "list").select("list", deal("member", "m_blocks").alias("i"), copies("v_blocks").alias("j"), F.lit(False).alias("visits"), "id", "row", *none(visits, [c for c in own if c not in theirs]), *theirs)
        return v.unionByName(m).groupBy("list", "i", "j")

    def mark(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        visits = rows["visits"].to_numpy(bool)
        v, m = rows[visits], rows[~visits]
        if not len(v) or not len(m):
            return pd.DataFrame({"row": [], "visits": [], "list": []})
        unit = np.stack([np.frombuffer(b, np.int8) for b in v["near"]]) * v["step"].to_numpy()[:, None]
        codes = np.stack([np.frombuffer(b, np.uint8) for b in m["codes"]])
        hits = marked(sent.value, int(key[0]), {"id": v["id"].to_numpy(), "unit": unit, "error": v["off"].to_numpy()}, {"id": m["id"].to_numpy(), "codes": codes, "error": m["error"].to_numpy()}, cosine)
        row = np.concatenate([v["row"].to_numpy()[hits[0]], m["row"].to_numpy()[hits[1]]])
        return pd.DataFrame({"row": row, "visits": np.arange(len(row)) < hits[0].sum(), "list": np.full(len(row), key[0], np.int32)})

    every = placed.select("id", "row", F.explode("probes").alias("list"), "near", "step", "off")
    home = placed.select("id", "row", F.col("probes")[0].alias("list"), "codes", "error")
    marks = held(met(every, home, ["near", "step", "off"], ["codes", "error"]).applyInPandas(mark, "row long, visits boolean, list int").distinct())

    def pairs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        def side(part: pd.DataFrame) -> dict[str, np.ndarray]:
            x = scaled(np.stack(part["v"].to_numpy()))
            norm = np.linalg.norm(x, axis=1)
            probed = np.stack(part["probes"].to_numpy())
            return {"id": part["id"].to_numpy(), "raw": x, "norm": norm, "unit": x / norm[:, None], "probes": probed, "home": probed[:, 0]}

        visits = rows["visits"].to_numpy(bool)
        if not visits.any() or visits.all():
            return pd.DataFrame({"id": [], "n": [], "root": []})
        counts, edges = search(sent.value, int(key[0]), side(rows[visits]), side(rows[~visits]), cosine)
        out = np.concatenate([np.insert(counts, 2, -1, 1), np.insert(edges, 1, 0, 1)]) if len(counts) else np.zeros((0, 3), np.int64)
        tied = np.concatenate([np.zeros(len(counts), bool), np.ones(len(edges), bool)])
        return pd.DataFrame({"id": out[:, 0], "n": out[:, 1], "root": [int(r) if t else None for r, t in zip(out[:, 2], tied, strict=True)]})

    wanted = held(fine.join(marks.select("row").distinct(), "row", "left_semi").join(placed.select("row", "probes"), "row"))
    fetched = marks.join(wanted, "row")
    return met(fetched.where("visits").drop("visits"), fetched.where(~F.col("visits")).drop("visits"), ["v", "probes"], ["v", "probes"]).applyInPandas(pairs, FOUND)
