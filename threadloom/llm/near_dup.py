"""MinHash near-duplicates: banded candidates, sequential Bayesian pruning, exact check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from threadloom.llm.common import block_pairs, blocks, flat, mix, runs, word_hashes, word_spans
from threadloom.llm.components import components
from threadloom.session import runtime_conf, store

WIDTH = 5  # words of a shingle
PERCENT = 75  # links need 100 * intersection >= PERCENT * union
ROWS, BANDS = 5, 36  # a pair at 0.75 shares no band with probability (1 - 0.75**5)**36 < 6e-5
HASHES = ROWS * BANDS
BATCH = 36  # signature entries compared before the next decision
MISS = 1e-6  # chance that a pruned pair is a link after all
HUBS = 6  # hubs that a node is held against before components are compared
BLOCK = 2000  # signatures of a component that one task holds
NODES, SHINGLES = 8192, 1 << 21  # nodes and shingles of their full sets in a block that is verified

_rng = np.random.RandomState(20240229)
_SEEDS = _rng.randint(0, 2**32, (HASHES, 1), dtype=np.uint64).astype(np.uint32)
_FACTORS = _rng.randint(0, 2**32, (HASHES, 1), dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_PLACES = mix(np.arange(1, WIDTH + 2, dtype=np.uint64)) | np.uint64(1)
_BAND_FACTORS = mix(np.arange(100, 100 + ROWS, dtype=np.uint64)) | np.uint64(1)
_BAND_SALT = mix(np.arange(1000, 1000 + BANDS, dtype=np.uint64))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text, in order.

    Fewer than five words make one shingle of the whole sequence; no words, no
    shingle. Texts are taken in blocks of about a megabyte.
    """
    data, offsets = flat(texts)
    for first, last in blocks(offsets):
        part = data[offsets[first] : offsets[last]]
        edges = offsets[first : last + 1] - offsets[first]
        starts, ends = word_spans(part, edges)
        words = word_hashes(part, starts, ends)
        at = np.searchsorted(starts, edges)
        rolled = np.zeros(0, np.uint64)
        if len(words) >= WIDTH:
            n = len(words) - WIDTH + 1
            rolled = np.zeros(n, np.uint64)
            for k in range(WIDTH):
                rolled += words[k : k + n] * _PLACES[k]
            rolled = mix(rolled)
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if hi - lo >= WIDTH:
                yield np.unique(rolled[lo : hi - WIDTH + 1])
            elif hi > lo:
                length = np.array([hi - lo], np.uint64) * _PLACES[WIDTH]
                yield mix(length + (words[lo:hi] * _PLACES[: hi - lo]).sum(dtype=np.uint64))
            else:
                yield rolled[:0]


def signature(shingles: np.ndarray, step: int = 1024) -> np.ndarray:
    """The smallest value of every permutation over one non-empty set."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(short), step):
        values = short[None, lo : lo + step] ^ _SEEDS
        values *= _FACTORS
        np.minimum(best, values.min(axis=1), out=best)
    return best


_SIGNED = "struct<n:bigint,key:bigint,bands:array<bigint>,sig:binary>"


def _signed(texts: pa.Array) -> pa.Array:
    counts, keys = [], []
    signatures = np.zeros((len(texts), HASHES), np.uint32)
    for row, found in enumerate(shingle_sets(texts)):
        counts.append(len(found))
        keys.append(mix(found ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))
        if len(found):
            signatures[row] = signature(found)
    counts = np.array(counts, np.int64)
    keys = np.array(keys, np.uint64)
    keys = mix(keys + counts.astype(np.uint64)).view(np.int64)
    bands = mix(
        (signatures.reshape(-1, BANDS, ROWS).astype(np.uint64) * _BAND_FACTORS).sum(
            axis=2, dtype=np.uint64
        )
        + _BAND_SALT
    ).view(np.int64)
    size = np.where(counts > 0, BANDS, 0)
    lists = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
        pa.array(bands[counts > 0].reshape(-1)),
    )
    low = signatures.astype(np.uint8)
    packed = pa.array([row.tobytes() for row in low], pa.binary())
    return pa.StructArray.from_arrays(
        [pa.array(counts), pa.array(keys), lists, packed], ["n", "key", "bands", "sig"]
    )


def least_matches(threshold: float = PERCENT / 100, miss: float = MISS) -> np.ndarray:
    """For each number of compared entries the fewest matches that go on.

    With an even prior on the similarity, fewer matches leave a posterior chance
    below ``miss`` that the pair reaches ``threshold``. One byte of each entry is
    kept, so different ones still match by chance once in 256.
    """
    s = (np.arange(4000) + 0.5) / 4000
    p = s + (1 - s) / 256
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        m = np.arange(n + 1)[:, None]
        logs = m * np.log(p) + (n - m) * np.log1p(-p)
        weight = np.exp(logs - logs.max(axis=1, keepdims=True))
        above = weight[:, s >= threshold].sum(axis=1) / weight.sum(axis=1)
        out.append(int(np.argmax(above >= miss)))
    return np.array(out)


def likely(left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which rows of two equally long signature tables survive, batch by batch."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for k, bound in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= bound]
    return alive


def _table(column) -> np.ndarray:
    data, _ = flat(column)
    return data.reshape(-1, HASHES)


def _prune(batches):
    least = least_matches()
    for batch in batches:
        left, right = _table(batch.column("sa")), _table(batch.column("sb"))
        keep = likely(left, right, least)
        yield batch.select(["a", "b"]).take(pa.array(keep))


def _meet(batches):
    """(a, b): components that likely pairs join, at most one row per node of a pair of blocks.

    Two components that are already joined by earlier rows are not compared again.
    """
    least = least_matches()
    for group in runs(batches, ["bucket", "_i", "_j"]):
        root, side = group.column("root").to_numpy(), group.column("_side").to_numpy()
        sig = _table(group.column("sig"))
        same = group.column("_i")[0].as_py() == group.column("_j")[0].as_py()
        lefts = np.flatnonzero(side == 0)
        rights = lefts if same else np.flatnonzero(side == 1)
        top = root.copy()
        a, b = [], []
        for x in lefts.tolist():
            others = rights[rights > x] if same else rights
            others = others[top[others] != top[x]]
            hits = others[likely(np.broadcast_to(sig[x], (len(others), HASHES)), sig[others], least)]
            for other in np.unique(top[hits]).tolist():
                a.append(int(top[x]))
                b.append(other)
                top[top == other] = top[x]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _sift(batches):
    """(key, root) of the visiting nodes with a likely partner among the signatures of a room."""
    least = least_matches()
    place, parts, stay = None, [], None
    for batch in batches:
        places = zip(batch.column("root").to_pylist(), batch.column("block").to_pylist(), strict=True)
        visits, nodes = batch.column("visits").to_pylist(), batch.column("key").to_pylist()
        sig = _table(batch.column("payload"))
        keys, roots = [], []
        for row, here in enumerate(places):
            if here != place:
                place, parts, stay = here, [], None
            if not visits[row]:
                parts.append(sig[row])
                continue
            if stay is None and parts:
                stay = np.array(parts)
            if stay is not None:
                left = np.broadcast_to(sig[row], stay.shape)
                if len(likely(left, stay, least)):
                    keys.append(nodes[row])
                    roots.append(here[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(roots, pa.int64())], ["key", "root"]
        )


def _verify(batches):
    """Links between nodes of different components, at most one row per component of a pair of blocks.

    Nodes of two components are held against each other by size, then by signature,
    then by their full sets, until a link joins the components.
    """
    least = least_matches()
    for group in runs(batches, ["cluster", "_i", "_j"]):
        key, root, side = (group.column(c).to_numpy() for c in ("key", "root", "_side"))
        sig = _table(group.column("sig"))
        data, offsets = flat(group.column("shingles"))
        shingles, edges = data.view(np.uint64), offsets // 8
        size = np.diff(edges)
        same = group.column("_i")[0].as_py() == group.column("_j")[0].as_py()
        lefts = np.flatnonzero(side == 0)
        rights = lefts if same else np.flatnonzero(side == 1)
        top = root.copy()
        a, b = [], []
        for x in lefts.tolist():
            others = rights[rights > x] if same else rights
            near = (100 * size[others] >= PERCENT * size[x]) & (100 * size[x] >= PERCENT * size[others])
            others = others[near & (top[others] != top[x])]
            others = others[likely(np.broadcast_to(sig[x], (len(others), HASHES)), sig[others], least)]
            if not len(others):
                continue
            own = shingles[edges[x] : edges[x + 1]]
            found = np.concatenate([shingles[edges[y] : edges[y + 1]] for y in others.tolist()])
            at = np.searchsorted(own, found)
            at[at == len(own)] = 0
            shared = np.add.reduceat(own[at] == found, np.append(0, np.cumsum(size[others])[:-1]), dtype=np.int64)
            linked = others[100 * shared >= PERCENT * (size[x] + size[others] - shared)]
            for other, y in zip(*np.unique(top[linked], return_index=True), strict=True):
                a.append(int(key[x]))
                b.append(int(key[linked[y]]))
                top[top == other] = top[x]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _set_bytes(texts: pa.Array) -> pa.Array:
    return pa.array([found.tobytes() for found in shingle_sets(texts)], pa.binary())


def _confirm(batches):
    """Links of the sorted stream: a hub's set, then the sets to hold against it."""
    hub_key, hub = None, None
    for batch in batches:
        keys = list(zip(batch.column("a").to_pylist(), batch.column("salt").to_pylist(), strict=True))
        others = batch.column("b").to_pylist()
        column = batch.column("shingles")
        a, b = [], []
        for row, key in enumerate(keys):
            found = np.frombuffer(column[row].as_buffer(), np.uint64)
            if others[row] is None:
                hub_key, hub = key, found.copy()
            elif key == hub_key:
                low, high = (found, hub) if len(found) < len(hub) else (hub, found)
                at = np.searchsorted(high, low)
                at[at == len(high)] = 0
                shared = int((high[at] == low).sum())
                if 100 * shared >= PERCENT * (len(low) + len(high) - shared):
                    a.append(key[0])
                    b.append(others[row])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _sets(needed: DataFrame, signed: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, shingles) of the nodes in ``needed``, made again from their texts."""
    holders = (
        signed.select("key", "doc_id").join(needed, "key", "left_semi")
        .groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    )
    # A repeated id with different texts has several sets; the key tells them apart.
    texts = docs.join(holders.select("doc_id").distinct(), "doc_id", "left_semi")
    made = texts.select(
        arrow_udf(_signed_key, "bigint")(F.col("text")).alias("key"),
        arrow_udf(_set_bytes, "binary")(F.col("text")).alias("shingles"),
    )
    return store(made.join(needed, "key", "left_semi"), "sets").dropDuplicates(["key"])


def _confirmed(pairs: DataFrame, signed: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (hub a, member b) whose full shingle sets are similar enough.

    Each pair moves the set of ``b`` once; that of ``a`` is copied once per 1000
    pairs.
    """
    needed = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    with runtime_conf(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="500"):
        sets = _sets(needed, signed, docs)
        fan = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 1000).cast("int").alias("fan"))
        dealt = pairs.join(fan, "a").select(
            "a", "b", F.pmod(F.xxhash64("b"), F.col("fan")).cast("int").alias("salt")
        )
        hubs = dealt.select("a", "salt").distinct().join(
            sets.withColumnRenamed("key", "a"), "a"
        ).select("a", "salt", F.lit(None).cast("bigint").alias("b"), "shingles")
        members = dealt.join(sets.withColumnRenamed("key", "b"), "b").select(
            "a", "salt", "b", "shingles"
        )
        return store(
            hubs.unionByName(members)
            .repartition("a", "salt")
            .sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
            .mapInArrow(_confirm, "a bigint, b bigint"),
            "confirmed",
            rows=pairs.count(),
        )


def _rooms(meetings: DataFrame, placed: DataFrame, payload: DataFrame, size: int) -> DataFrame:
    """Components in blocks of ``size`` nodes, each followed by the nodes that visit it.

    ``meetings`` has the (key, root) of nodes and the components to search;
    ``placed`` the (key, root) of all nodes in question; ``payload`` what is
    known of a key. A node stays once and visits every block of its component.
    """
    stay = placed.join(meetings.select("root").distinct(), "root", "left_semi")
    blocks_of = stay.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("n"))
    at_home = stay.join(blocks_of, "root").select(
        "root", F.pmod(F.xxhash64("key"), F.col("n")).cast("int").alias("block"), "key",
        F.lit(0).alias("visits"),
    )
    visit = meetings.join(blocks_of, "root").select(
        "root", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block"), "key",
        F.lit(1).alias("visits"),
    )
    return (
        at_home.unionByName(visit)
        .join(payload, "key")
        .repartition("root", "block")
        .sortWithinPartitions("root", "block", "visits")
    )


def _signed_key(texts: pa.Array) -> pa.Array:
    counts, keys = [], []
    for found in shingle_sets(texts):
        counts.append(len(found))
        keys.append(mix(found ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))
    keys = np.array(keys, np.uint64) + np.array(counts, np.uint64)
    return pa.array(mix(keys).view(np.int64))


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: str | None = None
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    1. Every text gives its set of five-word shingles (lower-cased A-Z), a key
       of the whole set, MinHash bands and a signature of one byte per hash.
       Documents of one key are copies and count as one node from here on.
    2. Every node is held against ``HUBS`` hubs, the nodes of smallest rank in
       its buckets by as many hashes: matching signature entries are counted
       batch by batch, a pair is dropped once the posterior chance of reaching
       the threshold falls below ``MISS``, and survivors are checked on full
       sets. A large group of near copies so costs a few pairs per member and
       not a pair for every two of them.
    3. Where a bucket still holds several components, its nodes visit the signatures
       of the largest one, and those of the others are compared in the bucket, in
       blocks, both with the same pruning. Only the components that likely pairs
       join come out, never the pairs: at most a row per node. Components joined in
       any chain are a cluster, whose nodes are held against each other in blocks,
       by size, signature and full set, until a link joins their components. So
       every pair of a bucket is pruned or checked unless a link already joins its
       components, and a node moves its set once per block of its cluster.
    4. Components of the confirmed links; the smallest doc_id names each.

    Nodes are 64-bit keys of the sets: among 10**10 different texts about one
    pair shares one. Links at the threshold are missed with probability below
    6e-5 (no common band) plus 1e-6 (pruning).

    Null or empty text, or a text without words: no shingles, its own component.
    A null doc_id keeps its row, with null component and ``kept`` false, and
    links nothing. Repeated rows stay and share a component; repeated ids with
    other texts are separate documents. Other columns are ignored, but for
    ``carry``, which is given on as ``carried``; an empty table gives no rows.
    """
    docs = documents.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        *([] if carry is None else [F.col(carry).alias("carried")]),
    )
    carried = docs.columns[2:]
    with runtime_conf(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="1000"):
        signed = store(
            docs.select("doc_id", *carried, arrow_udf(_signed, _SIGNED)(F.col("text")).alias("s"))
            .select("doc_id", *carried, "s.*"),
            "signed",
        )
    n_docs = signed.count()
    nodes = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    rows = nodes.select("key", F.explode("bands").alias("bucket"))
    shared = (
        rows.groupBy("bucket")
        .agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
        .where("lo <> hi")
        .select("bucket")
    )
    members = store(rows.join(shared, "bucket", "left_semi").distinct(), "members")
    signatures = store(
        nodes.select("key", "sig")
        .join(members.select("key").distinct(), "key", "left_semi")
        .dropDuplicates(["key"]),
        "signatures",
        rows=n_docs,
    )

    ranks = [F.xxhash64(F.lit(k), "key") for k in range(HUBS)]
    hubs = members.groupBy("bucket").agg(
        *[
            F.min(F.struct(rank.alias("rank"), F.col("key").alias("hub"))).alias(f"h{k}")
            for k, rank in enumerate(ranks)
        ]
    )
    pairs = (
        members.join(hubs, "bucket")
        .groupBy("key")
        .agg(*[F.min(F.when(F.col(f"h{k}.hub") != F.col("key"), F.col(f"h{k}"))).alias(f"h{k}") for k in range(HUBS)])
        .select(
            F.explode(F.array_distinct(F.array(*[F.col(f"h{k}.hub") for k in range(HUBS)]))).alias("a"),
            F.col("key").alias("b"),
        )
        .where("a IS NOT NULL")
        .join(signatures.select(F.col("key").alias("a"), F.col("sig").alias("sa")), "a")
        .join(signatures.select(F.col("key").alias("b"), F.col("sig").alias("sb")), "b")
        .select("a", "b", "sa", "sb")
        .mapInArrow(_prune, "a bigint, b bigint")
    )
    roots = components(_confirmed(store(pairs, "pairs", rows=HUBS * n_docs), nodes, docs))

    placed = members.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "root", F.coalesce("root", "key")
    )
    mixed = (
        placed.groupBy("bucket")
        .agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        .where("lo <> hi")
        .select("bucket")
    )
    placed = store(placed.join(mixed, "bucket", "left_semi"), "open", rows=members.count())
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    weighed = placed.join(sizes, "root", "left").withColumn(
        "rank", F.struct(F.coalesce("size", F.lit(1)).alias("size"), F.col("root"))
    )
    # The nodes of a bucket visit its largest component; among themselves the
    # others are compared in the bucket.
    top = weighed.groupBy("bucket").agg(F.max("rank").alias("host"))
    others = store(
        weighed.join(top, "bucket")
        .where(F.col("rank") < F.col("host"))
        .select("bucket", "key", "root", F.col("rank.size").alias("size"), F.col("host.root").alias("host")),
        "others",
        rows=placed.count(),
    )
    meetings = others.select("key", F.col("host").alias("root")).distinct()
    several = (
        others.groupBy("bucket")
        .agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        .where("lo <> hi")
        .select("bucket")
    )
    compared = (
        block_pairs(
            others.drop("size", "host").join(several, "bucket", "left_semi").join(signatures, "key"),
            "bucket", "key", BLOCK,
        )
        .repartition("bucket", "_i", "_j")
        .sortWithinPartitions("bucket", "_i", "_j")
        .mapInArrow(_meet, "a bigint, b bigint")
    )
    everyone = placed.select("key", "root").distinct().unionByName(
        roots.select(F.col("node").alias("key"), "root")
    ).distinct()
    visited = (
        _rooms(meetings, everyone, signatures.withColumnRenamed("sig", "payload"), BLOCK)
        .mapInArrow(_sift, "key bigint, root bigint")
        .join(everyone.withColumnRenamed("root", "a"), "key")
        .select("a", F.col("root").alias("b"))
    )
    # Components that likely pairs join, in whatever chain, are verified together.
    clusters = components(store(compared.unionByName(visited).distinct(), "likely", rows=n_docs))
    searched = store(
        everyone.join(clusters.select(F.col("node").alias("root"), F.col("root").alias("cluster")), "root"),
        "clusters",
        rows=n_docs,
    )
    with runtime_conf(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="200"):
        sets = _sets(searched.select("key"), nodes, docs)
        full = searched.join(signatures, "key").join(sets, "key")
        more = store(
            block_pairs(full, "cluster", "key", NODES, F.length("shingles") / 8, SHINGLES)
            .repartition("cluster", "_i", "_j")
            .sortWithinPartitions("cluster", "_i", "_j")
            .mapInArrow(_verify, "a bigint, b bigint"),
            "verified",
        )
    if not more.isEmpty():
        roots = components(
            roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(more)
        )
    named = (
        signed.select("doc_id", *carried, F.col("n").alias("n_shingles"), "key")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    smallest = (
        named.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("root").agg(F.min("doc_id").alias("smallest"))
    )
    linked = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("root"))
    component = F.coalesce("smallest", "doc_id")
    return (
        named.withColumn("root", linked)
        .join(smallest, "root", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
            *carried,
        )
    )
