"""Near duplicates by SetSketch registers, banding, a likelihood estimate and full verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.arrow_tasks import map_arrow
from landledger.llm.components import connected_components
from landledger.llm.text_tables import ids_and_texts, narrow
from landledger.llm.word_hashes import NOT_SPACE, document_words, mix, ngrams
from landledger.storage import materialise

BASE = 1.001  # spacing of the register values
BANDS, BAND_REGISTERS = 30, 4
REGISTERS = BANDS * BAND_REGISTERS
LEADER_ROUNDS = 1
DEVIATIONS = 5.0  # pairs whose estimate lies this many standard deviations too low are dropped
_RANDOM = np.random.default_rng(7)
_FACTORS = (_RANDOM.integers(0, 2**31, REGISTERS, dtype=np.uint32) << 1) + np.uint32(1)
_SHIFTS = _RANDOM.integers(0, 2**32, REGISTERS, dtype=np.uint32)
_CHUNK = 1 << 12
_PLACES = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64)) | np.uint64(1)  # a factor for each place of a word
_STEP = np.uint64(0xA0761D6478BD642F)
PAIRED_UPTO = 16  # classes in a bucket whose pairs are joined; larger buckets are compared in blocks
BLOCK_ROWS = 400


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row, word hashes and sorted distinct hashes of ``k``-word shingles of each text."""
    for first, offsets, words, _ in document_words(column, NOT_SPACE):
        grams = ngrams(words, k)
        for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
            own = words[a:b]
            if b - a >= k:
                found = np.unique(grams[a : b - k + 1])
            else:  # too few words: the whole sequence is one shingle
                found = ngrams(own, len(own)) if len(own) else own
            yield first + i, own, found


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers: per hash function the smallest value over the set, on an exponential scale.

    Minima of unions are minima of minima, so sketches merge by taking the
    larger register. The value is floor(1 - log_BASE(minimum)), cut off at 16 bits.
    """
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(REGISTERS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(low), _CHUNK):
        least = np.minimum(least, (low[at : at + _CHUNK, None] * _FACTORS + _SHIFTS).min(axis=0))
    # a uniform minimum as an exponential one, which is what makes registers add up
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32)
    return np.clip(np.floor(1.0 - np.log(exponential) / np.log(BASE)), 0, 65535).astype(np.uint16)


def estimate(own: np.ndarray, other: np.ndarray, n_own: np.ndarray, n_other: np.ndarray) -> np.ndarray:
    """Jaccard similarity with the largest joint likelihood of the registers of two sets.

    With u and v the shares of the two sizes, a register of the first set is
    larger with probability p(u - vJ), smaller with p(v - uJ), where
    p(x) = -log_b(1 - x(b-1)/b); both counts together give the likelihood of J.
    """
    larger = (own > other).sum(axis=1)[:, None]
    smaller = (own < other).sum(axis=1)[:, None]
    equal = own.shape[1] - larger - smaller
    u = (n_own / (n_own + n_other))[:, None]
    v = 1.0 - u
    grid = np.linspace(0.0, 1.0, 201)[None, :] * np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-x * (BASE - 1.0) / BASE) / np.log(BASE)

    up, down = np.maximum(p(u - v * grid), 1e-12), np.maximum(p(v - u * grid), 1e-12)
    chance = larger * np.log(up) + smaller * np.log(down) + equal * np.log(np.maximum(1.0 - up - down, 1e-12))
    return grid[np.arange(len(grid)), chance.argmax(axis=1)]


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; a set
    holds the distinct shingles of ``shingle_words`` words, or the whole sequence
    if there are fewer. Documents are linked if 100 * intersection >= ``percent`` *
    union, counted on the full sets; component_id is the smallest doc_id reachable.

    Texts with the same words are one class and go on as one row. Every class gets
    a sketch; each band of four registers puts it into a bucket. At a similarity
    of 0.8 a pair misses all 30 bands once in ten million. Buckets do not emit
    their pairs: each class is tested against the leaders of its buckets; such pairs are screened by size and by the likelihood estimate,
    then verified on the full sets. What is still apart in a bucket after that is compared in
    full, by joined pairs in a bucket of up to ``PAIRED_UPTO`` classes, and in blocks that
    emit links alone in larger ones. So a bucket of thousands of near copies costs a few
    tests a member, and no link between components is lost.

    A null or empty text has an empty set and no link. Rows that share a doc_id
    count as one node: a link of any of them links the id. A row without a doc_id
    has no component and is kept. An empty table gives no rows; columns other than
    the two are not read.
    """
    sketches = materialise(_sketches(ids_and_texts(docs, id_column, text_column), shingle_words), "sketches")
    known = sketches.filter("doc_id IS NOT NULL")
    # small tables that hot keys are joined with are stored: a join of two exchanges can be split, one
    # that sits on an aggregate cannot
    classes = materialise(
        known.filter("n_shingles > 0").groupBy("words").agg(F.min("doc_id").alias("node")), "class-ids"
    )
    # several rows may share the id; any one of a class has the same sketch
    members = known.join(classes, "words").select("doc_id", "node")
    inside = members.filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct()
    leaders = materialise(
        known.join(classes, "words")
        .filter("doc_id = node")
        .select("words", "node", F.col("n_shingles").alias("n"), "sketch", "bands")
        .dropDuplicates(["words"])
        .drop("words"),
        "classes",
    )
    buckets = materialise(_buckets(leaders), "buckets")
    components = _components(docs, leaders, buckets, inside, shingle_words, percent, id_column, text_column)
    return (
        sketches.join(components, sketches.doc_id == components.node, "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def _sketches(texts: DataFrame, k: int) -> DataFrame:
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, sketches, bands = [], [], [], []
            for _, words, found in shingle_sets(batch.column("text"), k):
                counts.append(len(found))
                digests.append(_digest(words))
                own = registers(found) if len(found) else None
                sketches.append(None if own is None else own.tobytes())
                bands.append(own)
            keys = _band_keys(bands)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(sketches, pa.binary()), keys,
                ],
                names=["doc_id", "n_shingles", "words", "sketch", "bands"],
            )

    schema = "doc_id long, n_shingles long, words binary, sketch binary, bands array<long>"
    return map_arrow(texts, sketched, schema)


def _digest(words: np.ndarray) -> bytes:
    """128 bits of the word sequence."""
    one = two = np.uint64(len(words))
    with np.errstate(over="ignore"):
        for at in range(0, len(words), len(_PLACES)):
            own = words[at : at + len(_PLACES)]
            one = mix(one * _STEP + np.sum(own * _PLACES[: len(own)]))
            two = mix(two * _STEP + np.sum(mix(own + _PLACES[: len(own)])))
    return one.tobytes() + two.tobytes()


def _band_keys(sketches: list) -> pa.Array:
    """One 64-bit key for each band of each sketch; none for an empty set."""
    present = [s for s in sketches if s is not None]
    lengths = np.array([0] + [0 if s is None else BANDS for s in sketches])
    flat = np.empty(0, np.int64)
    if present:
        values = np.stack(present).reshape(len(present), BANDS, BAND_REGISTERS).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(present), BANDS)).copy()
        for i in range(BAND_REGISTERS):
            key = mix(key * np.uint64(0xD1342543DE82EF95) + values[:, :, i])
        flat = key.reshape(-1).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), pa.array(flat, pa.int64()))


def _buckets(leaders: DataFrame) -> DataFrame:
    """(bucket, node) of buckets with two classes or more."""
    rows = leaders.select("node", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("bucket")
    return rows.join(materialise(narrow(shared), "shared-buckets"), "bucket").select("bucket", "node")


def _components(docs, leaders, buckets, inside, k, percent, id_column, text_column) -> DataFrame:
    """Components (node, component) of the links within classes and of those that the buckets yield."""
    nodes = buckets.select("node").distinct()
    texts = materialise(
        ids_and_texts(docs, id_column, text_column)
        .join(nodes, F.col("doc_id") == F.col("node"), "left_semi")
        .dropDuplicates(["doc_id", "text"])
        .join(leaders.select("node", "n", "sketch"), F.col("doc_id") == F.col("node"))
        .select("node", "n", "sketch", "text"),
        "candidate-texts",
    )
    components, tested = inside, None
    labelled = buckets.withColumn("component", F.col("node"))
    for turn in range(LEADER_ROUNDS + 1):
        if turn < LEADER_ROUNDS:
            pairs = _leader_pairs(labelled, turn)
        else:
            sizes = materialise(narrow(_bucket_sizes(labelled)), "bucket-sizes")
            pairs = _pairs_across(labelled.join(sizes, "bucket").filter(F.col("size") <= PAIRED_UPTO))
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        found = _verify(_screen(pairs, texts, percent), texts, k, percent)
        if turn == LEADER_ROUNDS:
            large = labelled.join(sizes, "bucket").filter(F.col("size") > PAIRED_UPTO)
            found = found.union(_links_across(large, leaders, texts, k, percent))
        components = connected_components(components.toDF("a", "b").union(found))
        if turn == LEADER_ROUNDS:
            break
        joined = buckets.join(components, "node", "left").select(
            "bucket", "node", F.coalesce("component", "node").alias("component")
        )
        apart = joined.groupBy("bucket").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        ).filter("low < high").select("bucket")
        labelled = materialise(joined.join(materialise(narrow(apart), "apart-buckets"), "bucket"), "apart")
        if labelled.isEmpty():
            break
    return components


def _bucket_sizes(labelled: DataFrame) -> DataFrame:
    """Per bucket its classes, its most frequent component and how many classes are outside of it."""
    counted = labelled.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("members"))
    return counted.groupBy("bucket").agg(
        F.sum("members").alias("size"),
        F.max_by("component", F.struct("members", "component")).alias("main"),
        (F.sum("members") - F.max("members")).alias("minor"),
    )


def _links_across(large: DataFrame, leaders: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between components that share a large bucket, one for each class and component it reaches.

    Every class outside the bucket's main component is compared with all classes of the
    bucket on the full sets, in blocks of ``BLOCK_ROWS`` by ``BLOCK_ROWS`` classes, so a task holds two blocks
    and no pair is emitted but a link. A pair that shares several bands is compared in the first.
    """
    blocks = lambda count: F.ceil(F.col(count) / BLOCK_ROWS).cast("int")
    whole = large.filter("minor > 0").withColumn("alls", blocks("size")).withColumn("minors", blocks("minor"))
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = whole.select("bucket", "node", "component", F.lit(False).alias("minor"), deal("alls").alias("x"), every("minors").alias("y"))
    rows = rows.union(
        whole.filter("component <> main").select(
            "bucket", "node", "component", F.lit(True).alias("minor"), every("alls").alias("x"), deal("minors").alias("y")
        )
    )
    full = rows.join(leaders.select("node", "bands"), "node").join(texts.select("node", "text"), "node")

    def compared(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        node, component = (group.column(c).to_numpy() for c in ("node", "component"))
        minor = group.column("minor").to_numpy()
        text = group.column("text").chunk(0)
        sets = [found for _, _, found in shingle_sets(text, k)]
        bands = group.column("bands").chunk(0).flatten().to_numpy().reshape(-1, BANDS)
        here = int((bands[0] == group.column("bucket")[0].as_py()).argmax())
        alls = np.flatnonzero(~minor)
        sizes = np.array([len(sets[i]) for i in alls])
        pool = np.concatenate([sets[i] for i in alls]) if len(alls) else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(alls)), sizes)
        a, b = [], []
        for i in np.flatnonzero(minor):
            own = sets[i]
            wanted = ((bands[alls] == bands[i]).argmax(axis=1) == here) & (component[alls] != component[i])
            wanted &= 100 * np.minimum(sizes, len(own)) >= percent * np.maximum(sizes, len(own))
            if not wanted.any():
                continue
            at = np.minimum(np.searchsorted(own, pool), len(own) - 1)
            common = np.bincount(owner[own[at] == pool], minlength=len(alls))
            linked = np.flatnonzero(wanted & (100 * common >= percent * (sizes + len(own) - common)))
            _, one = np.unique(component[alls[linked]], return_index=True)
            a += [int(node[i])] * len(one)
            b += node[alls[linked[one]]].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return full.groupBy("bucket", "x", "y").applyInArrow(compared, "a long, b long")


def _leader_pairs(labelled: DataFrame, turn: int) -> DataFrame:
    """Every class of a bucket with the bucket's leader of this round, if they are in different components."""
    rank = F.struct(F.xxhash64("node", F.lit(turn)).alias("order"), "node", "component")
    leader = materialise(narrow(labelled.groupBy("bucket").agg(F.min(rank).alias("leader"))), "bucket-leaders")
    return (
        labelled.join(leader, "bucket")
        .filter("component <> leader.component")
        .select(F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b"))
    )


def _pairs_across(labelled: DataFrame) -> DataFrame:
    """All pairs of one small bucket whose components are still apart."""
    other = labelled.select("bucket", F.col("node").alias("b"), F.col("component").alias("c"))
    return (
        labelled.withColumnRenamed("node", "a")
        .join(other, "bucket")
        .filter("a < b AND component <> c")
        .select("a", "b")
    )


def _screen(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose registers do not speak against it."""
    side = texts.select("node", "n", "sketch")
    both = (
        pairs.join(side.toDF("a", "n_a", "sketch_a"), "a")
        .join(side.toDF("b", "n_b", "sketch_b"), "b")
        .filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    )
    wanted = percent / 100.0
    floor = wanted - DEVIATIONS * (wanted * (1.0 - wanted) / REGISTERS) ** 0.5

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                own, other = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                    for c in ("sketch_a", "sketch_b")
                )
                sizes = [batch.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b")]
                yield batch.select(["a", "b"]).filter(pa.array(estimate(own, other, *sizes) >= floor))

    return map_arrow(both, likely, "a long, b long")


def _verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs that hold on their full shingle sets."""
    side = texts.select("node", "text")
    both = pairs.join(side.toDF("a", "text_a"), "a").join(side.toDF("b", "text_b"), "b")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(shingle_sets(batch.column("text_a"), k), shingle_sets(batch.column("text_b"), k))
            keep = []
            for (_, _, a), (_, _, b) in sets:
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(both, linked, "a long, b long")
