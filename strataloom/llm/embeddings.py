"""Near-duplicate vectors through an inverted multi-index.

Two codebooks, one on each half of the vectors, form a grid of cells. Each vector stands in one
cell and visits the cells nearest to it, in the order of the summed squared distances to their
borders in both halves, up to a level at which `target_recall` of true links are met. For that,
`PROBES` distinct vectors, outside the sample that the codebooks are fitted on where there are
more, are compared with all vectors in blocks; with fewer than `LEAST_LINKS` links among them, the
sample is compared, too. The level holds for all their links and for the probes weighted alike, so
that one large group does not speak for the others, and is never below the one of neighbours at
exactly the wanted cosine in random directions; the recall on the links is logged. Of two
vectors the one in the cell with the smaller number visits the other. All pairs that meet are
verified in double precision, in blocks; a block returns counts and the components of its links,
never its pairs.

Equal vectors are folded first. Fitting uses at most `SAMPLE` distinct vectors; every vector is
indexed and every vector visits. Cells of any size are cut into blocks, so no cell is one task.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link
with nothing, nor do rows with a null id, whose component is null and which are kept; vectors of different lengths do
not link; equal vectors link; rows that share an id share a component; an empty table gives an
empty table; columns other than id and vector are not read.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .graph import components

COSINE = 0.9
TARGET_RECALL = 0.99
SAMPLE = 16_384
PROBES = 4096
LEAST_LINKS = 1000
LEVELS = 512  # steps in which levels of links are counted, rounded up
VECTORS_PER_CELL = 256
MOST_CENTRES = 4096
BLOCK = 2048

_LOG = logging.getLogger(__name__)


def _unit(raw, dim: int) -> np.ndarray:
    """Vectors of length one, in double precision, from their bytes."""
    x = np.frombuffer(b"".join(raw), dtype="<f8").reshape(-1, dim).copy()
    x /= np.abs(x).max(1, initial=1e-300)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own centre of each row, and the squared distance to the border of each centre's region."""
    d = (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)
    own = d.argmin(1)
    apart = np.sqrt(np.maximum(((centres[:, None] - centres[None]) ** 2).sum(-1), 1e-24)) if len(centres) <= 256 else None
    if apart is None:
        square = (centres * centres).sum(1)
        apart = np.sqrt(np.maximum(square[:, None] - 2 * centres @ centres.T + square, 1e-24))
    rows = np.arange(len(x))
    border = np.maximum(d - d[rows, own][:, None], 0) / (2 * apart[own])
    border[rows, own] = 0
    return own, border * border


def _codebook(x: np.ndarray, k: int, rng, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = ((centres * centres).sum(1) - 2 * x @ centres.T).argmin(1)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return centres


def fit_index(sample: np.ndarray, vectors: int, cosine: float, target_recall: float, seed: int = 5):
    """Both codebooks, and the level of neighbours in random directions, below which no level of visits may be."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    k = int(np.clip(np.sqrt(vectors / VECTORS_PER_CELL), 1, MOST_CENTRES))
    first, second = _codebook(sample[:, :dim // 2], k, rng), _codebook(sample[:, dim // 2:], k, rng)
    # Neighbours at exactly the wanted cosine, in random directions.
    some = sample[rng.choice(len(sample), min(len(sample), 2000), replace=False)]
    turn = rng.normal(size=some.shape)
    turn -= (turn * some).sum(1)[:, None] * some
    turn /= np.maximum(np.sqrt((turn * turn).sum(1)), 1e-300)[:, None]
    other = cosine * some + np.sqrt(max(0.0, 1 - cosine * cosine)) * turn
    rows = np.arange(len(some))
    levels = 0.0
    for part, centres in ((slice(0, dim // 2), first), (slice(dim // 2, dim), second)):
        _, border = _nearest(some[:, part], centres)
        own, _ = _nearest(other[:, part], centres)
        levels = levels + border[rows, own]
    return first, second, float(np.quantile(levels, target_recall, method="higher"))


def link_levels(x: np.ndarray, probes: np.ndarray, first: np.ndarray, second: np.ndarray, cosine: float, probe_cells=None):
    """Probe, and level at which the two meet, of each link between probes and rows of `x`; equal vectors always meet and are left out."""
    half = x.shape[1] // 2

    def cells(y):
        return _nearest(y[:, :half], first), _nearest(y[:, half:], second)

    (pa, border_pa), (pb, border_pb) = probe_cells or cells(probes)
    (xa, border_xa), (xb, border_xb) = cells(x)
    dots = x @ probes.T
    row, probe = np.nonzero((dots >= cosine) & (dots < 1 - 1e-12))
    a, b = xa[row], xb[row]
    c, d = pa[probe], pb[probe]
    # The vector in the cell with the smaller number visits.
    visits = a * len(second) + b <= c * len(second) + d
    return probe, np.where(visits, border_xa[row, c] + border_xb[row, d], border_pa[probe, a] + border_pb[probe, b])


def level_for(probe: np.ndarray, level: np.ndarray, links: np.ndarray, target_recall: float) -> float:
    """The smallest level that meets the target over all links, and over probes of equal weight."""
    order = np.argsort(level, kind="stable")
    probe, level, links = probe[order], level[order], links[order].astype(np.float64)
    out = 0.0
    for weight in (links, links / np.bincount(probe, links)[probe]):
        share = np.cumsum(weight)
        out = max(out, float(level[min(len(level) - 1, np.searchsorted(share, target_recall * share[-1]))]))
    return out


def visited_cells(first: np.ndarray, second: np.ndarray, level: float) -> Iterator[np.ndarray]:
    """Per vector, the cells with a summed border distance up to `level`, nearest first.

    `first` and `second` hold the border distances in both halves. The sequences are walked in
    ascending order; as soon as a sum passes the level, the rest of its sequence does, too.
    """
    k = second.shape[1]
    order_a, order_b = first.argsort(1, kind="stable"), second.argsort(1, kind="stable")
    for a, b, one, two in zip(order_a, order_b, np.take_along_axis(first, order_a, 1), np.take_along_axis(second, order_b, 1)):
        one = one[:np.searchsorted(one, level, side="right")]
        reach = np.searchsorted(two, level - one, side="right")
        cells = np.concatenate([a[i] * k + b[:n] for i, n in enumerate(reach)])
        sums = np.concatenate([one[i] + two[:n] for i, n in enumerate(reach)])
        yield cells[sums.argsort(kind="stable")]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reached from each of n nodes over the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked_blocks(meeting: pd.DataFrame, dim: int, cosine: float) -> pd.DataFrame:
    """Verify one block: counts of links per class, and a link to the smallest class of each component."""
    probe = meeting["probe"].to_numpy()
    there, coming = meeting[~probe], meeting[probe]
    out = pd.DataFrame({"cls": [], "other": [], "links": []}).astype(np.int64)
    if not len(there) or not len(coming):
        return out
    x, y = _unit(coming["vec"], dim), _unit(there["vec"], dim)
    p, i = coming["cls"].to_numpy(), there["cls"].to_numpy()
    close = x @ y.T >= cosine
    inside = coming["own"].to_numpy()
    close &= ~inside[:, None] | (p[:, None] < i[None, :])  # inside a cell each pair meets once
    a, b = np.nonzero(close)
    if not len(a):
        return out
    n_p, n_i = coming["n"].to_numpy(), there["n"].to_numpy()
    ids = np.concatenate([p, i])
    links = np.concatenate([close @ n_i, close.T @ n_p])
    names, at = np.unique(ids, return_inverse=True)
    root = names[_roots(len(names), at[a], at[len(p) + b])]
    total = np.bincount(at, weights=links, minlength=len(names)).astype(np.int64)
    found = total > 0
    return pd.DataFrame({"cls": names[found], "other": root[found], "links": total[found]})


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                 target_recall: float = TARGET_RECALL) -> DataFrame:
    """Per row: id, `n_links`, `component_id`, `kept`."""
    spark = vectors.sparkSession

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "dim": [len(v) for v in batch["v"]],
                                "vec": [np.asarray(v, dtype="<f8").tobytes() for v in batch["v"]]})

    kind = vectors.schema[id_col].dataType.simpleString()
    v = F.col(vector_col).cast("array<double>")
    usable = (
        F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.exists(v, lambda x: x != 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    )
    fine = F.coalesce(usable, F.lit(False))
    rows = materialize(
        vectors.where(fine).select(F.col(id_col).alias("id"), v.alias("v")).mapInPandas(packed, f"id {kind}, dim int, vec binary"))
    classes = materialize(
        rows.groupBy("dim", "vec").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
        .withColumn("cls", F.monotonically_increasing_id()))
    found = None
    for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():  # lengths in use
        part = _links(classes.where(F.col("dim") == r["dim"]), r["dim"], r["n"], cosine, target_recall)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "cls long, other long, links long")
    found = materialize(found)

    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    ids = rows.join(classes.select("dim", "vec", "cls", "least", "n"), ["dim", "vec"]).select("id", "cls", "least", "n")
    members = materialize(ids.join(links, "cls", "left").select(
        "id", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    names = classes.select("cls", "least")
    ends = found.where("cls <> other").join(names, "cls").join(
        names.select(F.col("cls").alias("other"), F.col("least").alias("b")), "other").select(F.col("least").alias("a"), "b")
    edges = ends.unionByName(members.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")).distinct())
    groups = components(edges)
    good = members.join(groups, members["id"] == groups["node"], "left").select(
        F.col("id").alias(id_col), "n_links", F.coalesce("component", "id").alias("component_id"))
    bad = vectors.where(~fine).select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _measured_level(classes: DataFrame, some: np.ndarray, dim: int, first: np.ndarray, second: np.ndarray, cosine: float,
                    target_recall: float, least: float) -> float:
    """The level that the links between all vectors and the last of `some` need, or 0 without any."""
    # A border between two vectors is no farther than they are apart, so no link needs a higher level than this.
    step = max(2 * (1 - cosine), 1e-12) / LEVELS

    def counted(probes: np.ndarray) -> pd.DataFrame:
        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            half = dim // 2
            cells = _nearest(probes[:, :half], first), _nearest(probes[:, half:], second)
            for whole in batches:
                for at in range(0, len(whole), 250):
                    probe, level = link_levels(_unit(whole["vec"].iloc[at:at + 250], dim), probes, first, second, cosine, cells)
                    bins = np.minimum(np.ceil(level / step - 1e-9).astype(np.int64), 2 * LEVELS - 1)
                    names, n = np.unique(probe * (2 * LEVELS) + bins, return_counts=True)
                    yield pd.DataFrame({"probe": names // (2 * LEVELS), "level": names % (2 * LEVELS), "links": n})

        found = classes.select("vec").mapInPandas(work, "probe long, level long, links long")
        return found.groupBy("probe", "level").agg(F.sum("links").alias("links")).toPandas()

    probes = some[-PROBES:]
    found = counted(probes)
    if found["links"].sum() < LEAST_LINKS and len(some) > len(probes):
        found, probes = counted(some), some
    if not len(found):
        return 0.0
    probe, level, links = (found[c].to_numpy() for c in ("probe", "level", "links"))
    wanted = level_for(probe, level * step, links, target_recall)
    reached = links[level * step <= max(wanted, least)].sum() / links.sum()
    _LOG.info("level %.4f meets %.4f of %d links of %d vectors; neighbours in random directions need %.4f",
              max(wanted, least), reached, links.sum(), len(probes), least)
    return wanted


def _links(classes: DataFrame, dim: int, count: int, cosine: float, target_recall: float) -> DataFrame:
    some = classes.orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE + PROBES).select("vec").toPandas()
    some = _unit(some["vec"], dim)
    first, second, level = fit_index(some[:SAMPLE], count, cosine, target_recall)
    level = max(level, _measured_level(classes, some, dim, first, second, cosine, target_recall, level))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.iloc[at:at + 500]
                x = _unit(batch["vec"], dim)
                own_a, border_a = _nearest(x[:, :dim // 2], first)
                own_b, border_b = _nearest(x[:, dim // 2:], second)
                own = own_a * len(second) + own_b
                cells = [c[c >= o] for o, c in zip(own, visited_cells(border_a, border_b, level))]
                sizes = [len(c) for c in cells]
                row = np.repeat(np.arange(len(batch)), sizes)
                probes = batch.iloc[row].assign(cell=np.concatenate(cells), probe=True)
                probes["own"] = probes["cell"].to_numpy() == own[row]
                yield pd.concat([batch.assign(cell=own, probe=False, own=True), probes])[names]

    schema = "cls long, n long, vec binary, cell long, probe boolean, own boolean"
    names = [x.split()[0] for x in schema.split(", ")]
    visits = classes.select("cls", "n", "vec").mapInPandas(visit, schema)
    # The sizes are counted on a run without the vectors; a cell of many rows becomes several blocks.
    sizes = materialize(visits.groupBy("cell").agg(
        F.ceil(F.count(F.when(F.col("probe"), 1)) / BLOCK).alias("p_blocks"),
        F.ceil(F.count(F.when(~F.col("probe"), 1)) / BLOCK).alias("i_blocks")).where("i_blocks > 0"))
    cut = visits.join(sizes, "cell").withColumns({
        "p_block": F.when(F.col("probe"), F.array(F.pmod(F.xxhash64("cls", F.lit(1)), F.col("p_blocks"))))
        .otherwise(F.sequence(F.lit(0).cast("long"), F.col("p_blocks") - 1)),
        "i_block": F.when(F.col("probe"), F.sequence(F.lit(0).cast("long"), F.col("i_blocks") - 1))
        .otherwise(F.array(F.pmod(F.xxhash64("cls"), F.col("i_blocks")))),
    }).withColumn("p_block", F.explode("p_block")).withColumn("i_block", F.explode("i_block"))
    return cut.select("cls", "n", "vec", "cell", "probe", "own", "p_block", "i_block").groupBy(
        "cell", "p_block", "i_block").applyInPandas(
            lambda meeting: linked_blocks(meeting, dim, cosine), "cls long, other long, links long")
