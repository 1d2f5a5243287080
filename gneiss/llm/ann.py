"""Approximate nearest neighbours: a robust-pruned directed graph per shard, searched by beam.

Equal vectors are one node with its smallest ids. Nodes are dealt to shards of bounded size by a hash. In a shard nodes
join in growing batches: a greedy search from the entry proposes neighbours, and pruning keeps one only if no kept
neighbour is nearer to it, by the factor ``alpha``, than the node itself; reverse edges are pruned the same way. Each
query runs a beam search in every shard, and the shards' best are merged by exact distances.

A shard's graph is one file in the shared folder, and so is a block of queries. Spark deals out pairs of their names; a
task opens both, so neither the index nor the queries are shuffled, and a lost task costs one pair.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gneiss.llm.common import settle, shared_dir

NEIGHBOURS = 10
QUERY_MODULUS = 100
#: Most nodes of a shard, fewer where they would take more than SHARD_BYTES; queries of a block, and those searched together.
SHARD_ROWS, SHARD_BYTES, BLOCK_ROWS, TOGETHER = 65_536, 128_000_000, 65_536, 256
#: Edges of a node, room for reverse edges before it is pruned again, width of the searches that build and that ask.
DEGREE, SLACK, BUILD_BEAM, SEARCH_BEAM, ALPHA = 40, 16, 64, 160, 1.1
#: A task takes more pairs of a shard and a block beyond so many.
_TASKS = 20_000
_BATCH, _PAIRS = 512, 4_000_000
#: A query further from the middle than so many times the furthest node is moved in to there: its order of nodes stays.
_FAR = 1e4


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows a (n, d) to rows b (n, m, d)."""
    diff = b - a[:, None, :]
    return np.einsum("nmd,nmd->nm", diff, diff)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of rows a (n, d) to rows b (n, m, d) in double precision; squares out of range are scaled first."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        square = _distances(a, b)
        out = np.sqrt(square)
        i, j = np.nonzero(~((square > 1e-290) & (square < 1e300)))
        diff = np.abs(b[i, j] - a[i])
        most = np.maximum(diff.max(axis=1, initial=0), np.finfo(np.float64).tiny)
        out[i, j] = np.where(np.isfinite(most), most * np.sqrt(((diff / most[:, None]) ** 2).sum(axis=1)), np.inf)
    return out


class Graph:
    """Nodes scaled around their middle to float32; edges (n, degree) of node numbers, -1 where free; entry: the node
    nearest to the middle. ``visited`` counts the distances that searches have computed."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray | None = None, entry: int | None = None):
        n = len(vectors)
        # Halved before they are summed or subtracted, so that no finite component overflows.
        self.middle = (vectors / n).sum(axis=0)
        half = vectors / 2 - self.middle / 2
        self.scale = max(float(np.abs(half).max(initial=0)), np.finfo(np.float64).tiny)
        self.vectors = np.ascontiguousarray(half / self.scale, dtype=np.float32)
        self.reach = _FAR * float(np.sqrt((self.vectors.astype(np.float64) ** 2).sum(axis=1).max(initial=1)))
        self.edges = np.full((n, DEGREE + SLACK), -1, dtype=np.int32) if edges is None else edges
        self.entry = int(np.argmin((self.vectors**2).sum(axis=1))) if entry is None else entry
        self.visited = 0

    def scaled(self, queries: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            q = np.clip((queries / 2 - self.middle / 2) / self.scale, -1e150, 1e150)
        far = np.sqrt((q**2).sum(axis=1, keepdims=True))
        return (q * np.minimum(1, self.reach / np.maximum(far, 1))).astype(np.float32)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(q, beam) nearest nodes found for scaled queries and their squared distances, padded by -1 and infinity.

        All queries step together; each expands its nearest unexpanded node until the beam holds none.
        """
        q, n = len(queries), len(self.vectors)
        ids = np.full((q, beam), -1, dtype=np.int64)
        dist = np.full((q, beam), np.inf, dtype=np.float32)
        ids[:, 0] = self.entry
        dist[:, 0] = ((queries - self.vectors[self.entry]) ** 2).sum(axis=1)
        open_dist = dist.copy()
        seen = np.zeros((q, n), dtype=bool)
        seen[:, self.entry] = True
        out_ids, out_dist, live = ids.copy(), dist.copy(), np.arange(q)
        while True:
            row = np.arange(len(live))
            at = open_dist.argmin(axis=1)
            more = np.isfinite(open_dist[row, at])
            if not more.all():
                out_ids[live[~more]], out_dist[live[~more]] = ids[~more], dist[~more]
                live, at, ids, dist, open_dist = live[more], at[more], ids[more], dist[more], open_dist[more]
                if not live.size:
                    break
                row = np.arange(len(live))
            open_dist[row, at] = np.inf
            near = self.edges[ids[row, at]].astype(np.int64)
            i, j = np.nonzero((near >= 0) & ~seen[live[:, None], near])
            fresh = near[i, j]
            seen[live[i], fresh] = True
            diff = self.vectors[fresh] - queries[live[i]]
            d = np.full(near.shape, np.inf, dtype=np.float32)
            d[i, j] = np.einsum("md,md->m", diff, diff)
            self.visited += len(fresh)
            all_ids, all_dist = np.concatenate([ids, near], axis=1), np.concatenate([dist, d], axis=1)
            keep = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
            row = row[:, None]
            ids, dist, open_dist = all_ids[row, keep], all_dist[row, keep], np.concatenate([open_dist, d], axis=1)[row, keep]
        out_ids[~np.isfinite(out_dist)] = -1
        order = np.argsort(out_dist, axis=1, kind="stable")
        row = np.arange(q)[:, None]
        return out_ids[row, order], out_dist[row, order]

    def prune(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """(m, degree) kept neighbours of each node out of its candidates (m, c), nearest first, -1 where free."""
        slice_rows = max(1, _PAIRS // max(1, candidates.shape[1]) ** 2)
        if len(nodes) > slice_rows:
            kept = np.empty((len(nodes), DEGREE), dtype=np.int32)
            by = np.argsort((candidates >= 0).sum(axis=1), kind="stable")  # few candidates together, many together
            for i in range(0, len(by), slice_rows):
                part = np.sort(candidates[by[i : i + slice_rows]], axis=1)[:, ::-1]
                kept[by[i : i + slice_rows]] = self.prune(nodes[by[i : i + slice_rows]], part[:, : max(1, int((part >= 0).sum(axis=1).max()))])
            return kept
        m = len(nodes)
        candidates = np.where(candidates == nodes[:, None], -1, candidates)
        ordered = np.sort(candidates, axis=1)
        ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
        near = self.vectors[ordered]
        own = self.vectors[nodes]
        d = np.where(ordered >= 0, _distances(own, near), np.inf)
        square = np.einsum("mcd,mcd->mc", near, near)
        between = square[:, :, None] + square[:, None, :] - 2 * near @ near.transpose(0, 2, 1)
        kept, count = np.full((m, DEGREE), -1, dtype=np.int32), np.zeros(m, dtype=np.int64)
        for _ in range(DEGREE):
            at = d.argmin(axis=1)
            ok = np.flatnonzero(np.isfinite(d[np.arange(m), at]))
            if not ok.size:
                break
            at = at[ok]
            kept[ok, count[ok]] = ordered[ok, at]
            count[ok] += 1
            shadow = ALPHA**2 * between[ok, at] <= d[ok]
            d[ok] = np.where(shadow, np.inf, d[ok])
            d[ok, at] = np.inf
        return kept

    def _add_reverse(self, source: np.ndarray, target: np.ndarray) -> None:
        """Edges target -> source; a node whose room is used up is pruned."""
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        have = (self.edges[nodes] >= 0).sum(axis=1)
        fits = have + count <= self.edges.shape[1]
        place = np.arange(len(target)) - np.repeat(first, count)
        direct = np.repeat(fits, count)
        self.edges[target[direct], (np.repeat(have, count) + place)[direct]] = source[direct]
        if not fits.all():
            full, most = nodes[~fits], int(count[~fits].max())
            extra = np.full((len(full), most), -1, dtype=np.int64)
            which = np.repeat(np.cumsum(~fits) - 1, count)
            extra[which[~direct], place[~direct]] = source[~direct]
            self._set(full, self.prune(full, np.concatenate([self.edges[full].astype(np.int64), extra], axis=1)))

    def _set(self, nodes: np.ndarray, kept: np.ndarray) -> None:
        self.edges[nodes] = -1
        self.edges[nodes, :DEGREE] = kept

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 11) -> Graph:
        graph = cls(vectors)
        n = len(graph.vectors)
        order = np.random.default_rng(seed).permutation(n)
        order = np.concatenate([[graph.entry], order[order != graph.entry]])
        done = 1
        while done < n:
            batch = order[done : min(n, done + max(1, min(done, _BATCH)))]
            found, _ = graph.search(graph.vectors[batch], min(BUILD_BEAM, max(2, done)))
            kept = graph.prune(batch, found)
            graph._set(batch, kept)
            source, target = np.repeat(batch, DEGREE), kept.ravel().astype(np.int64)
            graph._add_reverse(source[target >= 0], target[target >= 0])
            done += len(batch)
        wide = np.flatnonzero((graph.edges >= 0).sum(axis=1) > DEGREE)
        if wide.size:
            graph._set(wide, graph.prune(wide, graph.edges[wide].astype(np.int64)))
        graph.edges, graph.visited = np.ascontiguousarray(graph.edges[:, :DEGREE]), 0
        return graph


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part; of an id's rows the smallest vector is kept."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where("vec_id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def build_index(rows: DataFrame, k: int, folder: str, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row per shard, (dim, shard, path, nodes), with the shard's graph in a file of the folder; all rows are indexed.

    A node is a distinct vector with its k + 1 smallest ids: no result can hold more of them. A file is written under a
    name of its own and renamed to one that its shard gives, so a repeated task replaces it with an equal one.
    """
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    nodes = rows.withColumn("r", first).where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = settle(nodes.withColumn("dim", F.size("v")))
    shards = {}
    for r in nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per dimension
        most = max(1, min(shard_rows, SHARD_BYTES // (8 * r["dim"])))
        shards[r["dim"]] = -(-r["n"] // most)
    of_dim = F.create_map(*(F.lit(x) for pair in shards.items() for x in pair)) if shards else F.create_map().cast("map<int,int>")
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.try_element_at(of_dim, F.col("dim"))).cast("int"))
    store, root = _open(folder)
    store.create_dir(root, recursive=True)

    def run(key: tuple, t: pa.Table) -> pa.Table:
        dim, shard = (x.as_py() for x in key)
        v, ids = _matrix(t.column("v"), dim), t.column("ids").to_pylist()
        order = np.argsort([x[0] for x in ids], kind="stable")
        v, ids = v[order], [ids[i] for i in order]
        graph = Graph.build(v)
        out = io.BytesIO()
        np.savez(out, vectors=v, edges=graph.edges, entry=graph.entry, ids=np.concatenate(ids).astype(np.int64), ends=np.cumsum([len(x) for x in ids]))
        store, root = _open(folder)
        path = f"{root}/graph-{dim}-{shard}.npz"
        with store.open_output_stream(own := f"{path}.{uuid.uuid4().hex}") as f:
            f.write(out.getbuffer())
        store.move(own, path)
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "path": [path], "nodes": pa.array([len(v)], pa.int64())})

    built = nodes.select("dim", "shard", "v", "ids").groupBy("dim", "shard")
    return settle(built.applyInArrow(run, "dim int, shard int, path string, nodes long"))


def _members(ends: np.ndarray, ids: np.ndarray, nodes: np.ndarray, exact: np.ndarray, own: int, k: int) -> list[tuple[float, int]]:
    """The k nearest (distance, id) of the nodes found, the query's own id left out."""
    order = np.lexsort((nodes < 0, exact))
    last = exact[order[min(k, len(order) - 1)]]  # one node may be the query's own
    found: list[tuple[float, int]] = []
    for j in order:
        if exact[j] > last or nodes[j] < 0:
            break
        node = nodes[j]
        found += [(float(exact[j]), int(x)) for x in ids[ends[node - 1] if node else 0 : ends[node]] if x != own]
    return sorted(found)[:k]


def search(index: DataFrame, queries: DataFrame, folder: str, k: int = NEIGHBOURS, beam: int = SEARCH_BEAM, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each (vec_id, v) query, its own id left out.

    Blocks of queries are Parquet files beside the graphs; every pair of a shard and a block of its dimension is searched.
    """
    spark = queries.sparkSession
    blocks = -(-max(1, queries.count()) // block_rows)
    asked = f"{folder}/queries"
    queries.withColumn("dim", F.size("v")).repartition(blocks).write.partitionBy("dim").option("maxRecordsPerFile", block_rows).parquet(asked)
    from pyarrow import fs

    store, root = _open(asked)
    files = [(int(part[4:]), f.path) for f in store.get_file_info(fs.FileSelector(root, recursive=True)) if f.base_name.endswith(".parquet") for part in f.path.split("/") if part.startswith("dim=")]
    names = spark.createDataFrame(files, "dim int, block string")  # a name for some ten thousand queries
    pairs = index.select("dim", "path").join(names, "dim")
    pairs = pairs.repartition(max(1, min(_TASKS, pairs.count())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        store, _ = _open(folder)
        for b in batches:
            for dim, path, block in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with store.open_input_file(path) as f:
                    shard = np.load(io.BytesIO(f.read()))
                v, ids, ends = shard["vectors"], shard["ids"], shard["ends"]
                graph = Graph(v, shard["edges"], int(shard["entry"]))
                with store.open_input_file(block) as f:
                    for part in pq.ParquetFile(f).iter_batches(TOGETHER, columns=["vec_id", "v"]):
                        own, q = part.column(0).to_pylist(), _matrix(part.column(1), dim)
                        found, _ = graph.search(graph.scaled(q), min(beam, len(v)))
                        exact = np.where(found >= 0, _exact(q, v[found]), np.inf)
                        rows = [(i, x, d) for i, nodes, far in zip(own, found, exact, strict=True) for d, x in _members(ends, ids, nodes, far, i, k)]
                        columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
                        kinds = (pa.int64(), pa.int64(), pa.float64())
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS, query_modulus: int = QUERY_MODULUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by ``query_modulus``.

    Vectors that are null, empty, zero or hold a null or non-finite component, and null ids, take no part. A repeated id
    counts once (its smallest vector). Vectors meet only those of their own dimension. With fewer than k candidates all
    found are returned; an empty table gives no rows. Other columns are ignored. Distances are Euclidean, in double
    precision on the original components (infinite beyond its range); ties go to the smaller id.
    """
    folder = f"{shared_dir(vectors.sparkSession)}/neighbours-{uuid.uuid4().hex}"
    rows = settle(usable(vectors, id_col, vector_col))
    return search(build_index(rows, k, folder, shard_rows), rows.where(F.col("vec_id") % query_modulus == 0), folder, k)
