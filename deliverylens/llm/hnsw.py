"""Embedding near-duplicates over hierarchical navigable small-world graphs.

Vectors that may link (equal labels, equal lengths) are dealt into shards of bounded
size, and each shard's graph is written to a file in the shared folder. Shards are
queried with the vectors of their label, a pair of shards a task. Beams widen until an
audit against brute force on a sample of the queries finds enough of its links, or,
where the sample has few of them, of its nearest neighbours too;
what a search finds is kept only if its cosine, in double precision, is high enough.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deliverylens.llm.components import connected_components
from deliverylens.llm.storage import fresh_folder, open_folder, written

COSINE = 0.93
SHARD_ROWS = 16_384
NEIGHBOURS = 16  # of a vertex above the ground layer, twice as many on it
BUILD_BEAM = 48
BEAM = 16  # the first width of a search
AUDIT_ROWS = 96
AUDIT_RECALL = 0.99
AUDIT_LINKS = 100  # in a sample; with fewer, the nearest neighbours of its queries count too
AUDIT_NEAREST = 10
TOGETHER = 256  # searches in step
MOST_EXPANDED = 32  # vertices of one beam in a step
CACHED = 1 << 18  # numbers of vectors that are gathered at a time
SLACK = 1e-5  # by which single precision may miss a cosine
# a place of a beam: the distance in steps of 1 / DISTANCE, 31 bits for the vertex, one if expanded
DISTANCE, VERTEX, NOWHERE = 1 << 30, (1 << 31) - 1, np.int64((1 << 63) - 1)


class Graph:
    """A layered neighbourhood graph over unit vectors. It is walked in single precision."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.walked = vectors.astype(np.float32)
        self.layers: list[np.ndarray] = []  # per layer: row of neighbours, -1 where none
        self.entry = 0

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        """Insert all vectors, batches of up to half of what is there already, so that
        the searches of a batch run in step."""
        self = cls(vectors)
        n = len(vectors)
        heights = np.random.default_rng(42).geometric(1 - 1 / NEIGHBOURS, n) - 1
        # tall vertices come first, so that upper layers stand before they are walked
        order = np.argsort(-heights, kind="stable")
        self.entry = int(order[0])
        for layer in range(int(heights.max()) + 1):
            self.layers.append(np.full((n, NEIGHBOURS * (1 if layer else 2)), -1, np.int32))
        done = 1
        while done < n:
            batch = order[done : done + min(TOGETHER, max(1, done // 2))]
            self._insert(batch, heights)
            done += len(batch)
        return self

    def _insert(self, batch: np.ndarray, heights: np.ndarray) -> None:
        queries = self.walked[batch]
        beam = np.full((len(batch), 1), self.entry, np.int64)
        near_batch = queries @ queries.T
        np.fill_diagonal(near_batch, -2)
        for layer in range(len(self.layers) - 1, -1, -1):
            if layer:
                beam = self.search_layer(queries, beam, layer, 8)[0]
            joins = np.flatnonzero(heights[batch] >= layer)
            if len(joins):
                found, near = self.search_layer(queries[joins], beam[joins], layer, BUILD_BEAM)
                # the batch's own members are not in the graph yet
                among = near_batch[np.ix_(joins, joins)]
                peers = np.argsort(-among, axis=1, kind="stable")[:, : 2 * NEIGHBOURS]
                sims = np.concatenate((near, np.take_along_axis(among, peers, 1)), axis=1)
                ids = np.where(sims > -2, np.concatenate((found, batch[joins][peers]), axis=1), -1)
                self._connect(batch[joins], ids, sims, layer)

    def _chosen(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """For each vertex, of a row of candidates (-1 where none) and their cosines: the
        nearest that are not nearer to one already chosen than to the vertex (so that
        paths lead out of dense groups), filled up with the nearest others."""
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 3 * most]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        near = self.walked[ids]
        blocks = near @ near.transpose(0, 2, 1) > sims[:, None, :]
        free, taken, count = ids >= 0, np.zeros(ids.shape, bool), np.zeros(len(ids), int)
        for k in range(ids.shape[1]):
            takes = free[:, k] & (count < most)
            taken[:, k] = takes
            count += takes
            free &= ~(blocks[:, k] & takes[:, None])
        rest = np.where(taken, 0, np.where(ids >= 0, 1, 2))
        chosen = np.take_along_axis(ids, np.argsort(rest, axis=1, kind="stable")[:, :most], 1)
        return np.pad(chosen, ((0, 0), (0, most - chosen.shape[1])), constant_values=-1)

    def _connect(self, vertices: np.ndarray, ids: np.ndarray, sims: np.ndarray, layer: int) -> None:
        """Link new vertices with candidates, and those back, all vertices at once."""
        links = self.layers[layer]
        most = links.shape[1]
        step = max(1, CACHED // (ids.shape[1] * self.walked.shape[1]))
        # half of the places are left to those that come later
        for k in range(0, len(vertices), step):
            part = slice(k, k + step)
            links[vertices[part], : most // 2] = self._chosen(ids[part], sims[part], most // 2)
        rows, at = np.nonzero(links[vertices] >= 0)
        ends, starts = links[vertices[rows], at], vertices[rows]
        known = (links[ends] == starts[:, None]).any(axis=1)
        ends, starts = ends[~known], starts[~known]
        order = np.argsort(ends, kind="stable")
        ends, starts = ends[order], starts[order]
        others, first, counts = np.unique(ends, return_index=True, return_counts=True)
        if not len(others):
            return
        held = np.full((len(others), most + counts.max()), -1, links.dtype)
        held[:, :most] = links[others]
        held[np.repeat(np.arange(len(others)), counts), most + np.arange(len(ends)) - np.repeat(first, counts)] = starts
        held = np.take_along_axis(held, np.argsort(held < 0, axis=1, kind="stable"), 1)
        sizes = (held >= 0).sum(axis=1)
        links[others] = held[:, :most]
        # where there is no room some must go; rows of like size are done together
        crowded = np.flatnonzero(sizes > most)
        crowded = crowded[np.argsort(-sizes[crowded], kind="stable")]
        while len(crowded):
            size = sizes[crowded[0]]
            step = max(1, CACHED // (size * self.walked.shape[1]))
            part, crowded = crowded[:step], crowded[step:]
            some = held[part, :size]
            near = np.einsum("rd,rkd->rk", self.walked[others[part]], self.walked[some])
            links[others[part]] = self._chosen(some, np.where(some < 0, np.float32(-2), near), most)

    def search_layer(self, queries: np.ndarray, starts: np.ndarray, layer: int, width: int):
        """Beam searches in step: the ``width`` nearest vertices that each query meets,
        nearest first, as (ids, cosines in single precision); -1 and -2 where there are
        fewer. A step expands the nearest of what is open, more of a wide beam, so that
        wide beams do not take more steps."""
        links, n = self.layers[layer], len(self.vectors)
        together = min(MOST_EXPANDED, max(1, width // BEAM))
        seen = np.zeros(len(queries) * n, np.int32)
        # a place of a beam is one number: distance, vertex, and whether it has been expanded
        beam = np.full((len(queries), width), NOWHERE)

        def meet(rows: np.ndarray, vertices: np.ndarray) -> None:
            """Put what queries (in ascending order) have not seen into their beams."""
            at = rows * n + vertices
            new = seen[at] == 0
            rows, vertices, at = rows[new], vertices[new], at[new]
            # a vertex that a query meets twice in a step counts once
            turn = np.arange(1, len(at) + 1, dtype=np.int32)
            seen[at] = turn
            new = seen[at] == turn
            rows, vertices = rows[new], vertices[new]
            near = np.empty(len(rows), np.float32)
            step = max(1, CACHED // queries.shape[1])
            for k in range(0, len(rows), step):
                part = slice(k, k + step)
                near[part] = np.einsum("nd,nd->n", queries[rows[part]], self.walked[vertices[part]])
            places = (np.maximum(1.0 - near.astype(np.float64), 0) * DISTANCE).astype(np.int64) << 32 | vertices << 1
            nearer = places < beam[rows, -1]
            rows, places = rows[nearer], places[nearer]
            if len(rows):
                some, first, counts = np.unique(rows, return_index=True, return_counts=True)
                joined = np.full((len(some), width + counts.max()), NOWHERE)
                joined[:, :width] = beam[some]
                joined[np.repeat(np.arange(len(some)), counts), width + np.arange(len(rows)) - np.repeat(first, counts)] = places
                joined.sort(axis=1)
                beam[some] = joined[:, :width]

        rows, at = np.nonzero(starts >= 0)
        meet(rows, starts[rows, at])
        active = np.arange(len(queries))
        while True:
            open_ = beam[active] & 1 == 0
            # a beam is done when it has nothing left to expand
            going = open_.any(axis=1)
            active, open_ = active[going], open_[going]
            if not len(active):
                break
            rows, at = np.nonzero(open_ & (np.cumsum(open_, axis=1) <= together))
            rows = active[rows]
            ahead = links[beam[rows, at] >> 1 & VERTEX].astype(np.int64)
            beam[rows, at] |= 1
            rows = np.repeat(rows, links.shape[1])[ahead.ravel() >= 0]
            meet(rows, ahead[ahead >= 0])
        none = beam == NOWHERE
        return np.where(none, -1, beam >> 1 & VERTEX), np.where(none, -2, 1 - (beam >> 32) / DISTANCE)

    def _down(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """A beam down the layers: ids and cosines as of ``search_layer``."""
        walking = queries.astype(np.float32)
        beam, near = np.full((len(queries), 1), self.entry, np.int64), np.empty(0)
        for layer in range(len(self.layers) - 1, -1, -1):
            beam, near = self.search_layer(walking, beam, layer, 8 if layer else width)
        return beam, near

    def nearest(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """A beam down the layers: ids, and cosines in double precision, as nearest first
        as single precision tells; -1 and -2 where there are fewer than ``width``."""
        beam, _ = self._down(queries, width)
        near = np.stack([self.vectors[ids] @ query for ids, query in zip(beam, queries, strict=True)])
        return beam, np.where(beam < 0, -2.0, near)

    def within(self, queries: np.ndarray, width: int, least: float) -> np.ndarray:
        """For each query, which vertices with a cosine of ``least`` or more it meets:
        a beam down the layers, then on from each such vertex to those around it.
        Double precision decides."""
        met = np.zeros((len(queries), len(self.vectors)), bool)
        beam, near = self._down(queries, width)
        close = near >= least - SLACK
        for k in np.flatnonzero(close[:, 0]).tolist():
            frontier = beam[k][close[k]]
            frontier = frontier[self.vectors[frontier] @ queries[k] >= least]
            hits = met[k]
            hits[frontier] = True
            looked = hits.copy()
            while len(frontier):
                ahead = np.unique(self.layers[0][frontier])
                ahead = ahead[ahead >= 0]
                ahead = ahead[~looked[ahead]]
                looked[ahead] = True
                frontier = ahead[self.vectors[ahead] @ queries[k] >= least]
                hits[frontier] = True
        return met

    @staticmethod
    def packed(queries: np.ndarray, search: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """What a search meets, a bit for each query and vertex, some queries at a time."""
        parts = (queries[k : k + TOGETHER] for k in range(0, len(queries), TOGETHER))
        return np.concatenate([np.packbits(search(part), axis=1) for part in parts])

    def audited(self, queries: np.ndarray, least: float, own: bool = False) -> tuple[np.ndarray, int, float]:
        """What ``audit`` finds as a matrix of truth values, its width and recall."""
        bits, width, recall, _ = self.audit(queries, least, own)
        return np.unpackbits(bits, axis=1, count=len(self.vectors)).astype(bool), width, recall

    def audit(self, queries: np.ndarray, least: float, own: bool = False) -> tuple[np.ndarray, int, float, int]:
        """``within``, in bits, at the first width whose recall on an evenly spread sample of the
        queries is high enough, with that width, its recall and the number of true
        vertices that this rests on. Sought are the sample's links; if there are fewer
        than ``AUDIT_LINKS``, the nearest neighbours of its queries, whatever their
        cosine, must be found as well, and recall is the lower of both. With ``own`` the
        queries are the graph's vertices, and none counts as its own neighbour. A beam
        as wide as the shard ends the widening: then brute force answers."""
        sample = np.unique(np.linspace(0, len(queries) - 1, min(AUDIT_ROWS, len(queries))).astype(int))
        near = queries[sample] @ self.vectors.T
        if own:
            near[np.arange(len(sample)), sample] = -2.0
        truth = near >= least
        links = int(truth.sum())
        most = min(AUDIT_NEAREST, len(self.vectors) - own) if links < AUDIT_LINKS else 0
        bounds = np.sort(near, axis=1)[:, -most] - 1e-9 if most else None
        sought = links + most * len(sample)
        width = BEAM
        while True:
            recall = (self.within(queries[sample], width, least) & truth).sum() / links if links else 1.0
            if most:
                ids, cosines = self.nearest(queries[sample], width)
                hits = cosines >= bounds[:, None]
                if own:
                    hits &= ids != sample[:, None]
                recall = min(recall, np.minimum(hits.sum(axis=1), most).sum() / (most * len(sample)))
            if recall >= AUDIT_RECALL:
                return self.packed(queries, lambda part: self.within(part, width, least)), width, float(recall), sought
            if width >= len(self.vectors):
                return self.packed(queries, lambda part: part @ self.vectors.T >= least), width, 1.0, sought
            width *= 2

    def save(self, sink, **columns: np.ndarray) -> None:
        """Write the graph, and columns of its vertices beside it."""
        held = io.BytesIO()
        layers = {f"layer{k}": x for k, x in enumerate(self.layers)}
        np.savez(held, vectors=self.vectors, entry=self.entry, **layers, **columns)
        sink.write(held.getvalue())

    @classmethod
    def load(cls, source) -> tuple[Graph, dict[str, np.ndarray]]:
        data = dict(np.load(io.BytesIO(source.read())))
        self = cls(data.pop("vectors"))
        self.entry = int(data.pop("entry"))
        self.layers = [data.pop(f"layer{k}") for k in range(sum(name.startswith("layer") for name in data))]
        return self, data


SHARDS = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("dim", T.IntegerType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("file", T.StringType()),
    ]
)
AUDIT = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("dim", T.IntegerType()),
        T.StructField("shard_a", T.IntegerType()),
        T.StructField("shard_b", T.IntegerType()),
        T.StructField("width", T.LongType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("sought", T.LongType()),
    ]
)
FOUND = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("n_links", T.LongType()),
        T.StructField("least_id", T.LongType()),
        T.StructField("audit", AUDIT),
    ]
)


def build_shards(vectors: DataFrame, folder: str, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A graph file for each shard of ``vectors`` (id, weight, label, vector); returns
    the table of shards. A label's vectors are dealt by a hash of their ids into as
    many shards as keep each near ``shard_rows``."""
    sized = vectors.withColumn("dim", F.size("vector"))
    counts = written(sized.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")), "label-sizes")
    dealt = sized.join(counts, ["label", "dim"]).withColumn(
        "shard", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / shard_rows)).cast("int")
    )

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        vectors = np.stack(group["vector"].to_list()).astype(np.float64)
        # the largest component first: squares must not overflow
        vectors /= np.abs(vectors).max(axis=1, keepdims=True)
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        name = f"{uuid.uuid4().hex}.npz"
        system, top = open_folder(folder)
        system.create_dir(top, recursive=True)
        with system.open_output_stream(f"{top}/{name}") as sink:
            Graph.build(vectors).save(sink, ids=group["id"].to_numpy(), weights=group["weight"].to_numpy())
        head = group.iloc[0]
        return pd.DataFrame([(head["label"], head["dim"], head["shard"], name)], columns=SHARDS.names)

    return written(dealt.groupBy("label", "dim", "shard").applyInPandas(build, SHARDS), "shards")


def _blocks(bits: np.ndarray, n: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Rows of a bit matrix of ``n`` columns, some at a time."""
    for first in range(0, len(bits), TOGETHER):
        rows = slice(first, min(first + TOGETHER, len(bits)))
        yield rows, np.unpackbits(bits[rows], axis=1, count=n).astype(bool)


def symmetric(bits: np.ndarray) -> np.ndarray:
    """A square bit matrix made the same both ways, its diagonal empty."""
    n = len(bits)
    whole = np.empty_like(bits)
    for rows, block in _blocks(bits, n):
        # blocks begin at whole bytes
        columns = np.unpackbits(bits[:, rows.start // 8 : -(-rows.stop // 8)], axis=1, count=rows.stop - rows.start)
        block |= columns.astype(bool).T
        block[np.arange(len(block)), np.arange(rows.start, rows.stop)] = False
        whole[rows] = np.packbits(block, axis=1)
    return whole


def merge_groups(least: np.ndarray, one: int, others: np.ndarray) -> None:
    """Join the groups of ``one`` and ``others``: ``least`` has each vertex's smallest id."""
    met = np.unique(np.append(least[others], least[one]))
    if len(met) > 1:
        least[np.isin(least, met)] = met[0]


def query_shards(shards: DataFrame, folder: str, cosine: float = COSINE) -> DataFrame:
    """Query the shards of each label with its vectors: each shard with its own, and of two
    shards the first with those of the second. A link of two vectors is the same both ways,
    so one direction is enough, and the audit of a pair holds it against all true links
    of its sample.

    For each pair of shards and vector that links there: id, n_links (rows linked in that
    pair), least_id (the smallest id reached in it). A row without id for each pair
    holds its audit. Links are held as bits, one for each two vertices of a pair.
    """
    left = shards.select("label", "dim", *(F.col(c).alias(f"{c}_a") for c in ("shard", "file")))
    right = shards.select("label", "dim", *(F.col(c).alias(f"{c}_b") for c in ("shard", "file")))
    pairs = left.join(right, ["label", "dim"]).where("shard_a <= shard_b")

    def query(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, top = open_folder(folder)

        def graph(name: str) -> tuple[Graph, dict[str, np.ndarray]]:
            with system.open_input_stream(f"{top}/{name}") as source:
                return Graph.load(source)

        for batch in batches:
            for pair in batch.itertuples(index=False):
                own, names = graph(pair.file_a)
                ids, weights, n = names["ids"], names["weights"], len(names["ids"])
                within = pair.shard_a == pair.shard_b
                if within:
                    bits, *audit = own.audit(own.vectors, cosine, own=True)
                    bits = symmetric(bits)
                else:
                    other, others = graph(pair.file_b)
                    bits, *audit = own.audit(other.vectors, cosine)
                    ids, weights = np.append(ids, others["ids"]), np.append(weights, others["weights"])
                shift = 0 if within else n  # vertices of the rows come after those of the columns
                counts, least = np.zeros(len(ids), np.int64), ids.copy()
                for rows, block in _blocks(bits, n):
                    at = np.arange(rows.start, rows.stop) + shift
                    counts[at] += block @ weights[:n]
                    if not within:
                        counts[:n] += weights[at] @ block
                    for k in np.flatnonzero(block.any(axis=1)).tolist():
                        merge_groups(least, int(at[k]), np.flatnonzero(block[k]))
                some = counts > 0
                yield pd.DataFrame({"id": ids[some], "n_links": counts[some], "least_id": least[some], "audit": None})
                audit = (pair.label, pair.dim, pair.shard_a, pair.shard_b, *audit)
                yield pd.DataFrame(
                    {"id": [None], "n_links": [None], "least_id": [None], "audit": [dict(zip(AUDIT.names, audit))]}
                )

    n_pairs = max(1, pairs.count())
    return pairs.repartition(n_pairs).mapInPandas(query, FOUND)


def _searched(embeddings: DataFrame, cosine: float, shard_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Usable rows, their distinct vectors, and what ``query_shards`` finds among these."""
    spark = embeddings.sparkSession
    valid = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        # as text, so that labels of any type meet only their like
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    usable = rows.where(F.coalesce(valid, F.lit(False)))
    copies = written(
        usable.groupBy("label", "vector").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight")), "vectors"
    )
    folder = fresh_folder(spark, "graphs")
    found = written(query_shards(build_shards(copies, folder, shard_rows), folder, cosine), "links")
    return usable, copies, found


def audit_vectors(embeddings: DataFrame, cosine: float = COSINE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The audit of each pair of shards that ``near_vectors`` searches: label, dim,
    shard_a, shard_b, width of the beam, recall, and sought (the true links and
    neighbours, found by brute force, that the recall rests on)."""
    found = _searched(embeddings, cosine, shard_rows)[2]
    audits = found.where("audit is not null").select("audit.*")
    return audits.withColumn("label", F.col("label").cast(embeddings.schema["label"].dataType))


def near_vectors(embeddings: DataFrame, cosine: float = COSINE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """vec_id, n_links (other rows linked directly), component_id (smallest vec_id
    reachable) and kept (vec_id = component_id), one row for each input row.

    Rows without a label or id, and vectors that are null, empty, zero or hold null or
    non-finite components, link with nothing; labels may be of any type with a text of
    its own, and meet only their like. A row without links is its own component (null,
    and not kept, without an id). Equal vectors of a label are searched once and link
    with each other. Vectors of other lengths do not link. A vec_id that repeats counts
    as one name: its rows share links and component. Only vec_id, embedding and label
    are read; an empty table gives an empty result.
    """
    usable, copies, found = _searched(embeddings, cosine, shard_rows)
    found = found.where("id is not null")
    same = usable.join(copies, ["label", "vector"]).where("weight > 1").select("vec_id", "id", "weight")
    group = connected_components(
        found.select(F.col("id").alias("a"), F.col("least_id").alias("b")).unionAll(
            same.select(F.col("vec_id").alias("a"), F.col("id").alias("b"))
        )
    )
    # what a copy stands for counts for each of its rows
    per_id = found.groupBy("id").agg(F.sum("n_links").alias("n"))
    heads = copies.groupBy("id").agg(F.sum(F.col("weight") - 1).alias("own"))
    totals = heads.join(per_id, "id", "left").select("id", (F.col("own") + F.coalesce("n", F.lit(0))).alias("n_links"))
    named = (
        same.select("vec_id", "id")
        .unionAll(copies.where("weight = 1").select(F.col("id").alias("vec_id"), "id"))
        .distinct()
        .join(totals, "id")
        .groupBy("vec_id")
        .agg(F.sum("n_links").alias("n_links"))
    )
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"))
        .join(written(named, "totals"), "vec_id", "left")
        .join(written(group.withColumnRenamed("id", "vec_id"), "groups"), "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
