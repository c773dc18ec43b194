"""Embedding near-duplicates with randomised-rotation binary codes.

Distinct vectors are normalised and routed to cells around centres fitted on a
bounded sample. Each vector is *home* in the cell of its nearest centre and a
*guest* in every cell whose border lies within r / 2, where r is the largest
distance of a link: the distances of two linked vectors from the border
between their cells sum to r at most, so one of them is a guest of the other's
cell, whatever the vectors' distribution. Every vector is compared, in its home
cell, with all members of that cell. A link to a guest counts for the vector at
home, and for the guest too unless the two meet again in the guest's own cell;
so both ends count it once and no pair has to be de-duplicated.

In a cell, members get a code: the signs of their rotated residual from the centre
(one bit per dimension) and the code's correction factor, its inner product with
the residual. Dividing by the factor makes the estimated inner product
unbiased, and the factor gives its confidence bound. Pairs whose upper bound
stays under the threshold are dropped; all others are recomputed exactly in
double precision, so no link below the threshold is returned.

Vectors travel as they were given, once to each group of neighbouring cells that
they are in, with a bit for each of their cells, instead of once to each cell with
its code: a vector is in many cells but there are few groups. A group is dealt out
as (home block, member block) tasks of bounded size, so a crowded one is many
tasks; codes are made where they are used. A task returns one row per vector (links
counted, smallest vector it is connected to inside the task), never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import discard, in_sample, stored
from marketlake.llm.components import components


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the rows that centres are fitted on and ``max_cells`` the centres; every vector is indexed.

    A task has about ``block`` vectors of either side at most, or ``held`` numbers of them where vectors are long.
    """

    cosine: float = 0.95
    bound: float = 4.0
    sample: int = 16384
    max_cells: int = 1024
    block: int = 65536
    held: int = 1 << 22
    seed: int = 6


def usable(v: Column) -> Column:
    """Not null or empty, no null or non-finite component, not all zero."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


#: Groups of cells, and blocks of members, at least: few vectors are many tasks too.
LEAST = 4
#: Pairs that a task looks at, and links that it gathers before it unites them, at once.
AT_ONCE = 1 << 22
#: More than the rounding errors of an upper bound in single precision.
SLACK = 1e-4


def _unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centres(sample: np.ndarray, cells: int, seed: int) -> np.ndarray:
    """A few rounds of k-means; empty cells keep their centre."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(6):
        near = (sample @ centres.T - 0.5 * (centres ** 2).sum(axis=1)).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def group_cells(centres: np.ndarray, share: np.ndarray, most: float) -> np.ndarray:
    """The group of each cell: neighbours halved along their widest direction until a group has ``most`` of all vectors, or one cell."""
    groups, found, rest = np.zeros(len(centres), np.int64), 0, [np.arange(len(centres))]
    while rest:
        cells = rest.pop()
        if len(cells) == 1 or share[cells].sum() <= most:
            groups[cells], found = found, found + 1
            continue
        apart = centres[cells] - centres[cells].mean(axis=0)
        order = np.argsort(apart @ np.linalg.svd(apart, full_matrices=False)[2][0], kind="stable")
        filled = share[cells[order]].cumsum()
        half = int(np.clip(np.searchsorted(filled, filled[-1] / 2), 1, len(cells) - 1))
        rest += [cells[order[half:]], cells[order[:half]]]
    return groups


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of unit vectors from the centres."""
    return 1 + (centres ** 2).sum(axis=1) - 2 * x @ centres.T


def _route(centres: np.ndarray, groups: np.ndarray, settings: Settings, kind: type):
    """Members of all groups: (group, vid, n, at home there, home cell, a bit per cell it is in, vector)."""
    margin = np.sqrt(max(0.0, 2 - 2 * settings.cosine)) / 2 + 1e-6
    sq = (centres ** 2).sum(axis=1)
    apart = np.sqrt(np.maximum(sq[:, None] + sq[None] - 2 * centres @ centres.T, 1e-18))
    of_group = (groups[:, None] == np.arange(groups.max() + 1)).astype(np.float32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 1024):
                b = whole.iloc[at:at + 1024]
                given = np.stack(b["v"].to_numpy()).astype(kind)
                d2 = _nearest(_unit(given), centres)
                home = d2.argmin(axis=1)
                member = (d2 - d2[np.arange(len(d2)), home][:, None]) / (2 * apart[home]) <= margin
                row, group = np.nonzero(member.astype(np.float32) @ of_group)
                cells, v = list(map(bytes, np.packbits(member, axis=1))), list(map(bytes, given))
                yield pd.DataFrame({"grp": group.astype(np.int32), "vid": b["vid"].to_numpy()[row], "n": b["n"].to_numpy()[row],
                                    "home": groups[home[row]] == group, "base": home[row].astype(np.int32),
                                    "cells": [cells[i] for i in row], "v": [v[i] for i in row]})
    return run


ROUTED = "grp int, vid long, n long, home boolean, base int, cells binary, v binary"


def _in_cell(bits: np.ndarray, cell: np.ndarray | int) -> np.ndarray:
    """Whether rows of packed bits have the bit of their cell."""
    return (bits[np.arange(len(bits)), cell >> 3] >> (7 - (cell & 7))) & 1 > 0


def _unite(least: np.ndarray, u: np.ndarray, w: np.ndarray) -> None:
    """Union of nodes by links: ``least`` names the smallest node that each is connected with."""
    while True:
        a, b = least[u], least[w]
        differ = a != b
        if not differ.any():
            return
        u, w, a, b = u[differ], w[differ], a[differ], b[differ]
        np.minimum.at(least, np.maximum(a, b), np.minimum(a, b))
        while (least[least] != least).any():
            least[:] = least[least]


def _pairwise(x: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray, held: int) -> np.ndarray:
    """Inner products of rows ``p`` of x with rows ``q`` of y, the same whichever comes first."""
    step = max(1, held // x.shape[1])
    return np.concatenate([np.einsum("ij,ij->i", x[p[i:i + step]], y[q[i:i + step]]) for i in range(0, len(p), step)] or [np.zeros(0)])


def _task(centres: np.ndarray, settings: Settings, kind: type):
    dim = centres.shape[1]
    turn = _rotation(dim, settings.seed)
    turned = centres @ turn.T

    def bounds(rest: np.ndarray, centre: np.ndarray) -> np.ndarray:
        """From residuals: what the left sides' inner product with gives the upper bound of each pair."""
        spread = np.linalg.norm(rest, axis=1)
        factor = np.maximum(np.abs(rest).sum(axis=1) / np.maximum(spread, 1e-12) / np.sqrt(dim), 1e-9)
        error = settings.bound * np.sqrt(np.maximum(1 - factor ** 2, 0)) / factor / np.sqrt(max(dim - 1, 1)) * spread
        code = np.where(rest > 0, 1.0, -1.0) * (spread / factor / np.sqrt(dim))[:, None]
        return np.column_stack((code, np.ones(len(rest)), error, (rest + centre) @ centre)).astype(np.float32)

    def links_in(x: np.ndarray, y: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of x and y that link: exact where the upper bound reaches the threshold."""
        u, w = np.nonzero(left @ right.T >= settings.cosine - SLACK)
        if 8 * len(u) < len(x) * len(y):
            exact = _pairwise(x, y, u, w, settings.held)
        else:
            exact = (x @ y.T)[u, w]
            close = np.abs(exact - settings.cosine) < 1e-9
            exact[close] = _pairwise(x, y, u[close], w[close], settings.held)
        return u[exact >= settings.cosine], w[exact >= settings.cosine]

    def run(task: pd.DataFrame) -> pd.DataFrame:
        a, b = task[task["first"]], task[~task["first"]]
        if not len(a) or not len(b):
            return pd.DataFrame({"vid": [], "links": [], "root": []}).astype("int64")
        x, y = (_unit(np.frombuffer(b"".join(side["v"]), kind).reshape(-1, dim)) for side in (a, b))
        reach, within = (np.frombuffer(b"".join(side["cells"]), np.uint8).reshape(len(side), -1) for side in (a, b))
        vid, other, of_home, of_member = a["vid"].to_numpy(), b["vid"].to_numpy(), a["n"].to_numpy(), b["n"].to_numpy()
        home, base = a["base"].to_numpy(), b["base"].to_numpy()
        turned_x, turned_y = x @ turn.T, y @ turn.T
        links, guest_links = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        names, node = np.unique(np.concatenate((vid, other)), return_inverse=True)
        least, met, pending = np.arange(len(names)), [], 0
        for cell in np.unique(home):
            p, q = np.nonzero(home == cell)[0], np.nonzero(_in_cell(within, int(cell)))[0]
            if not len(q):
                continue
            centre = turned[cell]
            right, rest = bounds(turned_y[q] - centre, centre), turned_x[p] - centre
            # <x, y> = <x - c, y - c> + <x - c, c> + <c, y>; the first term is estimated from the code, with its error
            left = np.column_stack((rest, rest @ centre, np.linalg.norm(rest, axis=1), np.ones(len(p)))).astype(np.float32)
            step = max(1, AT_ONCE // len(q))
            for i in range(0, len(p), step):
                u, w = links_in(x[p[i:i + step]], y[q], left[i:i + step], right)
                u, w = p[i + u], q[w]
                apart = vid[u] != other[w]
                u, w = u[apart], w[apart]
                np.add.at(links, u, of_member[w])
                once = ~_in_cell(reach[u], base[w])   # the guest does not meet this vector in its own cell
                np.add.at(guest_links, w[once], of_home[u[once]])
                met, pending = [*met, (node[u], node[len(a) + w])], pending + len(u)
                if pending > AT_ONCE // 4:
                    _unite(least, *map(np.concatenate, zip(*met)))
                    met, pending = [], 0
        if pending:
            _unite(least, *map(np.concatenate, zip(*met)))
        # smallest vector reachable over this task's links; a vector at home is told once at least, where it meets itself
        root_a, root_b = names[least[node[:len(a)]]], names[least[node[len(a):]]]
        here, moved = (root_a < vid) | (links > 0) | np.isin(vid, other), (root_b < other) | (guest_links > 0)
        return pd.DataFrame({"vid": np.concatenate((vid[here], other[moved])), "links": np.concatenate((links[here], guest_links[moved])),
                             "root": np.concatenate((root_a[here], root_b[moved]))})
    return run


def _links_of_dimension(distinct: DataFrame, settings: Settings) -> DataFrame:
    """(vid, links, root) rows of one dimension's distinct vectors (vid, n, v)."""
    total = distinct.count()
    picked = distinct.filter(in_sample(F.col("vid"), min(1.0, settings.sample / total))).select("v").limit(2 * settings.sample).toPandas()["v"]
    if not len(picked):
        picked = distinct.select("v").limit(settings.sample).toPandas()["v"]
    sample = _unit(np.stack(picked.to_numpy()))
    cells = int(min(settings.max_cells, max(1, round(np.sqrt(total)))))
    centres = fit_centres(sample, cells, settings.seed)
    kind = np.float32 if distinct.schema["v"].dataType.elementType.typeName() == "float" else np.float64
    block = max(1, min(settings.block, settings.held // sample.shape[1]))
    share = np.bincount(_nearest(sample, centres).argmin(axis=1), minlength=len(centres)) / len(sample)
    groups = group_cells(centres, share, min(1 / LEAST, block / total))
    homes = np.maximum(1, np.ceil(np.bincount(groups, weights=share) * total / block)).astype(int)   # blocks of each group's vectors at home
    members = max(LEAST, -(-total // block))   # blocks of its members, which are all vectors at most
    tasks = int(homes.sum()) * members
    routed = distinct.repartition(-(-total // 8192), "vid").mapInPandas(_route(centres, groups, settings, kind), ROUTED)
    blocks = F.element_at(F.lit(homes.tolist()).cast("array<int>"), F.col("grp") + 1)
    dealt = lambda of: F.pmod(F.xxhash64("vid", F.lit(of)), blocks if of == "home" else F.lit(members)).cast("int")
    first = F.transform(F.sequence(F.lit(0), F.lit(members - 1)), lambda m: F.struct(dealt("home").alias("hb"), m.alias("mb"), F.lit(True).alias("first")))
    second = F.transform(F.sequence(F.lit(0), blocks - 1), lambda h: F.struct(h.alias("hb"), dealt("member").alias("mb"), F.lit(False).alias("first")))
    sent = routed.select("*", F.explode(F.concat(F.when(F.col("home"), first).otherwise(F.slice(first, 1, 0)), second)).alias("to"))
    sent = sent.select("grp", "to.*", "vid", "n", "base", "cells", "v").repartition(tasks, "grp", "hb", "mb")
    return sent.groupBy("grp", "hb", "mb").applyInPandas(_task(centres, settings, kind), "vid long, links long, root long")


def near_vectors(vectors: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, links, component) per row: other rows linked directly, smallest id reachable.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing and are their own component, as are vectors of different
    dimension among each other. Equal vectors are compared once and counted as
    often as they come; rows that repeat an id count as rows. A null id is
    kept, and a component's name ignores it.
    """
    given = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"   # half as wide, the same numbers
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{given}>").alias("v"))
    rows = rows.withColumn("ok", usable(F.col("v")))
    good = rows.filter("ok")
    distinct = good.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    distinct = stored(distinct.withColumn("vid", F.monotonically_increasing_id()), "vectors")
    dims = [r[0] for r in distinct.groupBy(F.size("v")).count().collect()]
    found = None
    for d in dims:
        part = _links_of_dimension(distinct.filter(F.size("v") == d), settings)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    found = stored(found, "links")
    comp = stored(components(found.filter("root < vid"), "vid", "root"), "components")
    links = found.groupBy("vid").agg(F.sum("links").alias("links"))
    named = distinct.join(links, "vid").join(comp, F.col("vid") == F.col("node"), "left").withColumn("c", F.coalesce("component", "vid")).drop("component", "node")
    heads = named.groupBy("c").agg(F.min("least").alias("component"))
    lookup = stored(named.join(heads, "c").select("v", (F.col("links") + F.col("n") - 1).alias("links"), "component"), "lookup")
    discard(found, comp, distinct)
    linked = good.join(lookup, "v").select("id", "links", "component")
    alone = rows.filter("NOT ok").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    return linked.union(alone)
