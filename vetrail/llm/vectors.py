"""Near-duplicate embeddings: graphs per shard, links verified in double precision, components.

1. Equal vectors of a label collapse to one with a multiplicity.
2. A label's distinct vectors are dealt over shards of a bounded size. Each gets a hierarchical navigable
   small-world graph and is written once to the shared folder.
3. Every shard is asked for the neighbours of all vectors of its label, one block of shard size after the other;
   a task reads the two files it needs. The beam is widened until an audit passes. It asks two things: queries
   drawn at random, whose links are worked out by brute force and whose ends must be in one component of what was
   found, as a mean of shares per query; and queries made from vectors of the shard, turned by an angle within the
   limit, so that an audit has links to look for where copies are rare. Where beams up to an eighth of a shard fail,
   that block is worked out by brute force. Recall and beam of every meeting are reported.
4. A query and its verified links leave the task as ties to the smallest member of their local component,
   never as pairs, and the components are joined across tasks.
5. Inside a component the links are counted exactly, block against block, so a count does not depend on what
   a beam happened to return. Links are never counted across components.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrail.llm.common import shared_store
from vetrail.llm.components import connected_components
from vetrail.llm.hnsw import Hnsw
from vetrail.session import fresh_folder, materialized, with_package

THRESHOLD = 0.98
SHARD_ROWS = 8192
FIRST_BEAM = 32
#: Queries of a block that an audit draws, and queries it makes from vectors of the shard.
AUDIT_ROWS, AUDIT_MADE = 512, 128
AUDIT_RECALL = 0.99
COUNT_ROWS = 2048
#: Tasks over which the meetings of shards and blocks are dealt, at most.
MEETING_TASKS = 20_000
_SLACK = 1e-4


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable node per node of a local graph with edges a-b."""
    label = np.arange(n)
    while True:
        before = label
        label = label.copy()
        least = np.minimum(before[a], before[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


def _links(graph: Hnsw, exact: np.ndarray, queries: np.ndarray, beam: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(query row, node) of all verified links a beam finds."""
    rows, nodes = [], []
    for s in range(0, len(queries), 512):
        part = queries[s : s + 512]
        ids, near = graph.search(part.astype(np.float32), beam)
        r, c = np.nonzero((ids >= 0) & (near >= threshold - _SLACK))
        node = ids[r, c]
        cosine = np.einsum("kd,kd->k", part[r], exact[node])
        rows.append(r[cosine >= threshold] + s)
        nodes.append(node[cosine >= threshold])
    return np.concatenate(rows), np.concatenate(nodes)


def _exact_links(exact: np.ndarray, queries: np.ndarray, drawn: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(query row, node) of all links of the drawn queries, by brute force."""
    single, step = exact.astype(np.float32), max(1, (1 << 22) // max(1, exact.shape[1]))
    rows, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(0, len(drawn), 512):
        part = drawn[k : k + 512]
        r, node = np.nonzero(queries[part].astype(np.float32) @ single.T >= threshold - _SLACK)
        row = part[r]
        for s in range(0, len(row), step):
            a, b = row[s : s + step], node[s : s + step]
            links = np.einsum("kd,kd->k", queries[a], exact[b]) >= threshold
            rows.append(a[links])
            nodes.append(b[links])
    return np.concatenate(rows), np.concatenate(nodes)


def _made_queries(exact: np.ndarray, threshold: float) -> np.ndarray:
    """Unit vectors at random angles within the limit to vectors of the shard."""
    rng = np.random.default_rng(len(exact))
    base = exact[rng.permutation(len(exact))[:AUDIT_MADE]]
    aside = rng.normal(size=base.shape)
    aside -= np.einsum("kd,kd->k", aside, base)[:, None] * base
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = rng.uniform(min(threshold + 1e-6, 1.0), 1.0, size=(len(base), 1))
    return _units(cosine * base + np.sqrt(1 - cosine**2) * aside / np.where(length > 1e-9, length, np.inf))


def _recall(rows: np.ndarray, held: np.ndarray) -> float:
    """Mean over the queries of the share of their links that is held; 1 without links."""
    if not len(rows):
        return 1.0
    _, which = np.unique(rows, return_inverse=True)
    return float((np.bincount(which, held) / np.bincount(which)).mean())


def _search(
    ids: np.ndarray,
    exact: np.ndarray,
    graph: Hnsw,
    query_ids: np.ndarray,
    queries: np.ndarray,
    threshold: float,
    audit_rows: int | None = AUDIT_ROWS,
) -> tuple[np.ndarray, np.ndarray, int, float]:
    """Ties (member, smallest member) of a block's links to a shard, the beam (0: brute force) and the audited recall."""
    names, place = np.unique(np.concatenate([ids, query_ids]), return_inverse=True)
    node_at, query_at = place[: len(ids)], place[len(ids) :]

    def links_of(drawn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, nodes = _exact_links(exact, queries, drawn, threshold)
        others = query_at[rows] != node_at[nodes]
        return rows[others], nodes[others]

    every = np.arange(len(queries))
    beam, recall = 0, 1.0
    if audit_rows is None:
        rows, nodes = links_of(every)
    else:
        true_rows, true_nodes = links_of(np.random.default_rng(len(queries)).permutation(every)[:audit_rows])
        made = _made_queries(exact, threshold)
        made_rows, made_nodes = _exact_links(exact, made, np.arange(len(made)), threshold)
        wanted = np.minimum(np.bincount(made_rows, minlength=len(made)), FIRST_BEAM)
        asked, beam = np.concatenate([queries, made]), FIRST_BEAM
        while True:
            rows, nodes = _links(graph, exact, asked, min(beam, len(ids)), threshold)
            extra = rows >= len(queries)
            hit = np.isin(made_rows * len(ids) + made_nodes, (rows[extra] - len(queries)) * len(ids) + nodes[extra])
            got = np.minimum(np.bincount(made_rows[hit], minlength=len(made)), wanted)
            rows, nodes = rows[~extra], nodes[~extra]
            root = _roots(len(names), query_at[rows], node_at[nodes])
            held = root[query_at[true_rows]] == root[node_at[true_nodes]]
            recall = min(_recall(true_rows, held), float((got / np.maximum(wanted, 1))[wanted > 0].mean()))
            if recall >= AUDIT_RECALL:
                rows, nodes = np.concatenate([rows, true_rows]), np.concatenate([nodes, true_nodes])
                break
            beam *= 2
            if 8 * beam > len(ids):
                (rows, nodes), beam, recall = links_of(every), 0, 1.0
                break
    root = _roots(len(names), query_at[rows], node_at[nodes])
    tied = np.flatnonzero(root != np.arange(len(names)))
    return names[tied], names[root[tied]], beam, recall


def _write_shard(folder: str):
    def write(rows: pd.DataFrame) -> pd.DataFrame:
        """One row per shard: where its ids, vectors and graph lie. Attempts write files of their own."""
        rows = rows.sort_values("vec_id", kind="stable")
        exact = _units(np.stack(rows["vector"].to_numpy()).astype(np.float64))
        graph = Hnsw.build(exact.astype(np.float32))
        store, root = shared_store(folder)
        name = uuid.uuid4().hex
        for kind, part in (("rows", (rows["vec_id"].to_numpy(np.int64), exact)), ("graph", graph.layers)):
            with store.open_output_stream(f"{root}/{name}.{kind}") as out:
                out.write(pickle.dumps(part, protocol=5))
        first = rows.iloc[0]
        return pd.DataFrame({k: [first[k]] for k in ("label", "dim", "shard")} | {"file": [name]})

    return write


def _search_shards(folder: str, threshold: float, audit_rows: int | None):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = shared_store(folder)

        def load(name: str):
            with store.open_input_stream(f"{root}/{name}") as file:
                return pickle.loads(file.read())

        last = ids = exact = graph = None
        for batch in batches:
            for k, (file, asked) in enumerate(zip(batch.column("file").to_pylist(), batch.column("asked").to_pylist())):
                if file != last:
                    ids, exact = load(f"{file}.rows")
                    graph, last = Hnsw(exact.astype(np.float32), load(f"{file}.graph")), file
                query_ids, queries = load(f"{asked}.rows")
                a, b, beam, recall = _search(ids, exact, graph, query_ids, queries, threshold, audit_rows)
                audited = len(queries) if audit_rows is None or not beam else min(audit_rows, len(queries))
                none = pa.nulls(len(a), pa.int32())
                of_all = pa.array(np.full(len(a) + 1, k))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(a, pa.int64()), pa.nulls(1, pa.int64())]),
                        pa.concat_arrays([pa.array(b, pa.int64()), pa.nulls(1, pa.int64())]),
                        *[batch.column(c).take(of_all) for c in ("label", "shard", "block")],
                        pa.concat_arrays([none, pa.array([beam], pa.int32())]),
                        pa.concat_arrays([none.cast(pa.float64()), pa.array([recall], pa.float64())]),
                        pa.concat_arrays([none, pa.array([audited], pa.int32())]),
                    ],
                    names=["a", "b", "label", "shard", "block", "beam", "recall", "audited"],
                )

    return search


def graph_ties(
    distinct: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS, audit_rows: int | None = AUDIT_ROWS
) -> DataFrame:
    """Ties (a, b) of linked vectors, and per meeting of a shard and a block a row of its audit, where ``a`` is null.

    ``distinct`` has (label, vec_id, vector), equal vectors once. Audit rows give label, shard, block, beam
    (0: worked out by brute force), recall and the number of queries audited. With ``audit_rows`` None every block is
    worked out by brute force.
    """
    spark = with_package(distinct.sparkSession)
    distinct = distinct.select("label", "vec_id", "vector", F.size("vector").alias("dim"))
    sizes = distinct.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.lit(shard_rows)).cast("int").alias("shards"))
    sizes = materialized(sizes)
    dealt = distinct.join(sizes, ["label", "dim"]).withColumn(
        "shard", F.pmod(F.xxhash64("vec_id", F.lit("shard")), F.col("shards")).cast("int")
    )
    kind = distinct.schema["label"].dataType.simpleString()
    folder = fresh_folder(spark)
    store, root = shared_store(folder)
    store.create_dir(root, recursive=True)
    shards = materialized(
        dealt.groupBy("label", "dim", "shard").applyInPandas(
            _write_shard(folder), f"label {kind}, dim int, shard int, file string"
        )
    )
    # Every shard meets every block of its label once: names of files meet, not vectors.
    blocks = shards.select("label", "dim", F.col("shard").alias("block"), F.col("file").alias("asked"))
    meetings = int(sizes.agg(F.sum(F.col("shards").cast("long") * F.col("shards"))).first()[0] or 0)
    dealt = shards.join(blocks, ["label", "dim"]).select("label", "shard", "block", "file", "asked")
    return materialized(
        dealt.repartition(max(1, min(meetings, MEETING_TASKS))).mapInArrow(
            _search_shards(folder, threshold, audit_rows),
            f"a long, b long, label {kind}, shard int, block int, beam int, recall double, audited int",
        )
    )


def _count_block(threshold: float):
    def count(rows: pd.DataFrame) -> pd.DataFrame:
        ids, counts = [], []
        for _, part in rows.groupby("component", sort=False):
            i, j = int(part["_i"].iloc[0]), int(part["_j"].iloc[0])
            left, right = part[part["_own"] == i], part[part["_own"] == j]
            a = _units(np.stack(left["vector"].to_numpy()).astype(np.float64))
            b = _units(np.stack(right["vector"].to_numpy()).astype(np.float64))
            near = a @ b.T >= threshold
            if i == j:
                np.fill_diagonal(near, False)
            ids.append(left["vec_id"].to_numpy(np.int64))
            counts.append(near @ right["copies"].to_numpy(np.int64))
            if i != j:
                ids.append(right["vec_id"].to_numpy(np.int64))
                counts.append(near.T @ left["copies"].to_numpy(np.int64))
        return pd.DataFrame({"vec_id": np.concatenate(ids), "links": np.concatenate(counts)})

    return count


def near_duplicate_vectors(
    embeddings: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    shard_rows: int = SHARD_ROWS,
    audit_rows: int | None = AUDIT_ROWS,
    audit_folder: str | None = None,
) -> DataFrame:
    """Per row: id, n_links, component_id, kept.

    Rows link if their labels are equal and not null and their cosine reaches the threshold. Null vectors,
    vectors of length zero and vectors with null or non-finite parts link with nothing, as do vectors of
    different dimensions. Equal vectors link with each other. Rows that share an id count as vectors of
    their own, under one component. An empty table gives an empty result. Other columns are not read. With
    ``audit_rows`` None all links are found by brute force. The audits (see ``graph_ties``) are written to
    ``audit_folder`` where it is named.
    """
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label).alias("label"),
        F.transform(vector, lambda x: x.cast("double")).alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    usable = (
        F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & F.coalesce(finite & (length > 0) & (length < float("inf")), F.lit(False))
    )
    rows = rows.withColumn("_usable", usable)
    sound = rows.filter("_usable").drop("_usable")
    distinct = sound.groupBy("label", "vector").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies")
    )
    distinct = materialized(distinct)
    ties = graph_ties(distinct.withColumnRenamed("rep", "vec_id"), threshold, shard_rows, audit_rows)
    if audit_folder:
        ties.filter("a is null").drop("a", "b").write.parquet(audit_folder)
    found = materialized(connected_components(ties.filter("a is not null").select("a", "b")))
    in_component = distinct.withColumnRenamed("rep", "vec_id").join(
        found, F.col("vec_id") == F.col("node")
    ).drop("node")
    blocks_of = found.groupBy("component").agg(
        F.ceil(F.count("*") / F.lit(COUNT_ROWS)).cast("int").alias("_blocks")
    )
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda k: F.struct(F.least("_own", k).alias("_i"), F.greatest("_own", k).alias("_j")),
    )
    # Small components share groups of about COUNT_ROWS rows; a large one has its blocks' pairs for groups.
    groups = -(-found.count() // COUNT_ROWS) or 1
    group = F.when(F.col("_blocks") > 1, F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(groups)))
    counted = (
        in_component.join(blocks_of, "component")
        .withColumn("_own", F.pmod(F.xxhash64("vec_id", F.lit("count")), F.col("_blocks")).cast("int"))
        .withColumn("_pair", F.explode(pairs))
        .select(
            "vec_id", "copies", "vector", "component", "_own", "_pair._i", "_pair._j",
            group.alias("_group"), (F.col("_blocks") > 1).alias("_large"),
        )
        .groupBy("_large", "_group", "_i", "_j")
        .applyInPandas(_count_block(threshold), "vec_id long, links long")
        .groupBy("vec_id")
        .agg(F.sum("links").alias("links"))
    )
    of_distinct = (
        distinct.join(counted, F.col("rep") == counted["vec_id"], "left")
        .drop("vec_id")
        .join(found, F.col("rep") == F.col("node"), "left")
        .select(
            "label",
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    of_distinct = materialized(of_distinct)
    linked = rows.filter("_usable").join(of_distinct, ["label", "vector"])
    alone = rows.filter(~F.col("_usable")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        linked.select("vec_id", "n_links", "component_id")
        .union(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
        .withColumnRenamed("vec_id", id_column)
    )
