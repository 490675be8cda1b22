"""Collocations by Toivonen's mining: a sample proposes, full passes count proposals and their border."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landledger.llm.arrow_tasks import map_arrow
from landledger.llm.word_hashes import buffers, mix
from landledger.storage import materialise

MOST_WORDS = 4
MIN_COUNT, TOP, COVER = 30, 2000, 80
SCALE = 2_000_000
SAMPLE, SAMPLE_COUNT, SEED = 0.0625, 2, 11
SLICE_BYTES = 2 << 20  # text whose phrases are counted together before they leave the task
MOST_BITS = 1 << 28  # of a filter: 32 MB
BATCH_ROWS = 1 << 17  # rows that leave a task at once
BITMAP_BITS = 32_768  # bits of one group of bitmap_construct_agg
GRAMS = "gram string, count long"

_FOLD = np.arange(256, dtype=np.uint8)  # A-Z to lower case, tab to blank
_FOLD[65:91] += 32
_FOLD[9] = 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_BREAK
_WORD[32] = False


def mine_phrases(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    cover: int = COVER,
    longest: int = MOST_WORDS,
    sample: float = SAMPLE,
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z is lower-cased, texts are split at ``.,;:!?`` and line breaks, pieces into words between blanks and tabs.
    Candidates are phrases of 2 to ``longest`` words with ``a`` >= ``min_count`` occurrences in their
    language, overlaps included. A cut into a first part with ``l`` and a rest with ``r`` occurrences scores
    floor(2000000 a / (l + r)); the lowest cut counts, of equal ones the one with the shortest first part. A candidate
    inside a longer one with at least ``cover`` percent of its occurrences is left out. ``n`` is the language's words.

    ``frequent_phrases`` finds all frequent phrases exactly; the rest are joins of that table with itself,
    which is small beside the corpus, and a ranking in two steps, so that no task sorts a whole language.

    A null language is ``und``; a null or empty text has no words; repeated rows are separate
    texts. An empty table gives no rows. Other columns are not read.
    """
    return rank_phrases(frequent_phrases(docs, min_count, longest, sample, text_column, lang_column), top, cover)


def rank_phrases(found: DataFrame, top: int = TOP, cover: int = COVER) -> DataFrame:
    """The ranking of ``mine_phrases`` from the table of ``frequent_phrases``, in whole numbers of any size."""
    frequent = found.filter("words > 0").select("lang", "phrase", "words", F.col("f").alias("a"))
    candidates = frequent.filter("words > 1").withColumn("w", F.split("phrase", " "))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", 1, F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("words")), " ").alias("rest"),
    )
    part = lambda name, amount: frequent.select("lang", F.col("phrase").alias(name), F.col("a").alias(amount))
    score = F.expr(f"(cast(a AS decimal(38,0)) * {SCALE}) div (cast(l AS decimal(38,0)) + r)")
    scored = (
        cuts.join(part("first", "l"), ["lang", "first"])
        .join(part("rest", "r"), ["lang", "rest"])
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), "
        "i -> array_join(slice(w, i, m), ' '))))"
    )
    covers = (
        candidates.filter("words > 2").select("lang", "a", F.explode(inner).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    kept = scored.join(covers, ["lang", "phrase"], "left").filter(
        F.coalesce(wide("longer") * 100 < wide("a") * cover, F.lit(True))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    flat = kept.select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    # a share of the phrases each, then the best of the shares: at most 64 times ``top`` rows a language
    shares = Window.partitionBy("lang", "share").orderBy(*order)
    best = (
        flat.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
        .withColumn("rank", F.row_number().over(shares)).filter(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
        .filter(F.col("rank") <= top)
    )
    totals = found.filter("words = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def frequent_phrases(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    longest: int = MOST_WORDS,
    sample: float = SAMPLE,
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """All phrases of 1 to ``longest`` words with ``min_count`` occurrences or more: lang, phrase, words, f, exact.

    A row with no phrase and 0 words holds all word occurrences of a language.

    A ``sample`` of the rows proposes phrases, those it holds ``SAMPLE_COUNT`` times. A full pass counts
    the proposals and their negative border: phrases of which both the first and the last words but
    one are proposed. A phrase outside both has a part that is no more frequent and not proposed. Where a border
    phrase turns out frequent, a further pass counts what was not counted before and grows from frequent phrases: its
    first and its last words but one are frequent, or not counted before either. Passes go on until no phrase
    turns out frequent whose longer forms were left out. So the result does not depend on the sample.

    Whether a phrase is proposed is told by a Bloom filter, sixteen bits a phrase up to ``MOST_BITS``, the only data
    that is broadcast: phrases it takes by mistake are counted too, which costs time and changes nothing. Counts are
    summed within slices of text, then by Spark with partial sums, by the phrase's own text.
    """
    if not 2 <= longest <= 9:
        raise ValueError("phrases have 2 to 9 words")
    rows = docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    filters = [_proposals(rows.sample(sample, SEED), longest)]
    found = None
    while True:
        counted = _counts(rows, filters, longest, tested=longest - 1)
        wanted = (F.col("f") >= min_count) | (F.col("words") == 0)
        new = materialise(counted.filter(wanted), "phrase-counts")
        found = new if found is None else found.union(new)
        missed = new.filter(~F.col("known") & F.col("words").between(1, longest - 1))
        if missed.isEmpty():
            return found.select("lang", "phrase", "words", "f")
        filters.append(_filter(found.filter(F.col("words").between(1, longest - 1))))


def _proposals(rows: DataFrame, longest: int):
    """Filter of the phrases that a sample holds ``SAMPLE_COUNT`` times: words and pairs, then what pairs make."""
    often = F.col("f") >= SAMPLE_COUNT
    short = materialise(_counts(rows, [None], 2, tested=0).filter(often & (F.col("words") > 0)), "phrase-sample")
    if longest <= 2:
        return _filter(short)
    long = _counts(rows, [_filter(short)], longest - 1, tested=2, shortest=3).filter(often)
    return _filter(short.union(long))


def _counts(rows: DataFrame, filters: Sequence, longest: int, tested: int, shortest: int = 1) -> DataFrame:
    """lang, phrase, words, known, f of what the last filter lets through and no earlier one did."""
    context = rows.sparkSession.sparkContext
    shared = [None if f is None else context.broadcast(f) for f in filters]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blooms = [None if s is None else s.value for s in shared]
        for batch in batches:
            langs, lang_of = np.unique(batch.column("lang").to_numpy(zero_copy_only=False), return_inverse=True)
            for data, offsets, first_row, context in _slices(batch.column("text")):
                own = lang_of[first_row : first_row + len(offsets) - 1]
                yield from _slice_counts(data, offsets, own, langs, blooms, longest, tested, shortest, context)

    # one key column makes short rows: number of words, known or not, phrase, and the language behind a line break
    grams = map_arrow(rows, counted, GRAMS).groupBy("gram").agg(F.sum("count").alias("f"))
    body = F.expr("substring(gram, 3)")
    return grams.select(
        F.substring_index(body, "\n", 1).alias("phrase"),
        F.expr("substring(gram, 4 + length(substring_index(substring(gram, 3), '\n', 1)))").alias("lang"),
        F.substring("gram", 1, 1).cast("int").alias("words"),
        (F.substring("gram", 2, 1) == "1").alias("known"),
        "f",
    ).select("lang", F.when(F.col("words") > 0, F.col("phrase")).alias("phrase"), "words", "known", "f")


def _slices(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, row offsets, first row, words of context) of slices of about ``SLICE_BYTES``.

    A longer text is cut at gaps; each part but the first begins with up to eight words of the one before.
    """
    data, ends = buffers(texts)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + SLICE_BYTES, "right")) - 1)
        begin, end = int(ends[row]), int(ends[stop])
        if end - begin <= SLICE_BYTES:
            yield data[begin:end], ends[row : stop + 1] - begin, row, 0
        else:
            context = np.empty(0, np.uint8)
            while begin < end:
                cut = _gap(data, begin + SLICE_BYTES, end)
                part = np.concatenate([context, data[begin:cut]])
                yield part, np.array([0, len(part)]), row, _word_count(context)
                context = _last_words(part)
                begin = cut
        row = stop


def _gap(data: np.ndarray, at: int, end: int) -> int:
    """Place of the first byte from ``at`` on that is in no word, or ``end``."""
    while at < end:
        found = np.flatnonzero(~_WORD[_FOLD[data[at : min(end, at + 65_536)]]])
        if len(found):
            return at + int(found[0])
        at += 65_536
    return end


def _word_count(data: np.ndarray) -> int:
    return len(bytes(_FOLD[data]).split())


def _last_words(part: np.ndarray) -> np.ndarray:
    """Up to eight last words of the last piece of a part, each with a blank behind it."""
    folded = _FOLD[part]
    breaks = np.flatnonzero(_BREAK[folded])
    tail = folded[int(breaks[-1]) + 1 :] if len(breaks) else folded
    words = bytes(tail).rsplit(b" ")
    return np.frombuffer(b"".join(w + b" " for w in [w for w in words if w][-8:]), np.uint8)


def _slice_counts(data, offsets, lang_of_row, langs, blooms, longest, tested, shortest, context):
    """Record batches of (gram, count) of one slice of text.

    A phrase of one word is taken by every filter. A longer one is taken by a filter that knows its first and its last
    words but one. A filter knows a phrase that it takes and, up to ``tested`` words, holds; filters after the first
    also know what no earlier one took, as it was not counted yet and may be frequent. Counted is what
    the last filter takes and no earlier one.
    """
    text = _FOLD[data]
    blank = text == 32
    keep = np.ones(len(text), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])  # one blank between two words of a piece
    at = np.concatenate([[0], np.cumsum(keep)])[offsets]
    text = text[keep]
    inside = _WORD[text]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = at[(at > 0) & (at < len(text))]
    first[edges] |= inside[edges]
    last[edges - 1] |= inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    k = len(starts)
    if not k:
        return
    row = np.searchsorted(at, starts, "right") - 1
    piece = np.cumsum(_BREAK[text])[starts] + row  # grows at every break and every row
    lang = lang_of_row[row].astype(np.int64)
    code, known_words = _words(text[inside], ends - starts)
    word_hash = pd.util.hash_array(known_words, categorize=False)[code]
    lang_hash = pd.util.hash_array(langs.astype(object), categorize=False)
    size = len(known_words)
    fresh = np.zeros(k, dtype=bool)
    fresh[context:] = True

    if shortest == 1 and len(blooms) == 1:
        per_lang = np.bincount(lang, weights=fresh, minlength=len(langs)).astype(np.int64)
        some = np.flatnonzero(per_lang)
        yield _batch(np.empty(0, np.uint8), np.zeros(len(some), np.int64), np.zeros(len(some), np.int64), 0, np.ones(len(some), bool), langs, some, per_lang[some])
    knows = [None] * len(blooms)
    ids = None
    for n in range(1, longest + 1):
        count = k - n + 1
        if count <= 0:
            return
        if n == 1:
            takes = [np.ones(k, dtype=bool)] * len(blooms)
            key, places = lang * size + code, np.arange(k)
        else:
            within = piece[:count] == piece[n - 1 :]
            takes = [within & own[:count] & own[1:] for own in knows]
            places = np.flatnonzero(np.logical_or.reduce(takes))
            key = ids[places] * size + code[places + n - 1]
        gram_of, grams = pd.factorize(key)
        example = np.empty(len(grams), np.int64)
        example[gram_of[::-1]] = places[::-1]
        ids = np.full(count, -1, np.int64)
        ids[places] = gram_of
        if n <= tested:
            total = lang_hash[lang[example]]
            for i in range(n):
                total = total * np.uint64(0xD1342543DE82EF95) + word_hash[example + i]
            hashes = mix(total + np.uint64(n))
            knows, before = [], np.zeros(len(places), dtype=bool)
            for own, bloom in zip(takes, blooms):
                held = _holds(bloom, hashes)[gram_of]
                if knows:
                    held |= ~before
                before |= own[places]
                knows.append(own.copy())
                knows[-1][places] &= held
        else:
            knows = takes
        counted = takes[-1][places] & fresh[places + n - 1]
        for earlier in takes[:-1]:
            counted &= ~earlier[places]
        amounts = np.bincount(gram_of[counted], minlength=len(grams))
        some = np.flatnonzero(amounts)
        if n >= shortest and len(some):
            for low in range(0, len(some), BATCH_ROWS):
                part = some[low : low + BATCH_ROWS]
                spots = example[part]
                yield _batch(text, starts[spots], ends[spots + n - 1], n, knows[-1][spots], langs, lang[spots], amounts[part])


def _words(letters: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word among the distinct words, and these; ``letters`` holds the words without gaps."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(letters))
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False)


def _batch(text, starts, ends, words: int, known, langs, lang, counts) -> pa.RecordBatch:
    """Rows (gram, count) of the spans of ``text`` from ``starts`` to ``ends``; see ``_counts`` for a gram's form."""
    names = [b"\n" + name.encode() for name in langs]
    tails = np.frombuffer(b"".join(names), np.uint8)
    sizes = np.array([len(name) for name in names])
    lengths, own = ends - starts, sizes[lang]
    offsets = np.concatenate([[0], np.cumsum(lengths + own + 2)])
    letters = np.empty(offsets[-1], np.uint8)
    letters[offsets[:-1]] = ord("0") + words
    letters[offsets[:-1] + 1] = ord("0") + known.astype(np.uint8)
    for source, first, size, target in (
        (text, starts, lengths, offsets[:-1] + 2), (tails, (np.cumsum(sizes) - sizes)[lang], own, offsets[1:] - own)
    ):
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        letters[np.repeat(target, size) + inner] = source[np.repeat(first, size) + inner]
    grams = pa.StringArray.from_buffers(len(counts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(letters))
    return pa.RecordBatch.from_arrays([grams, pa.array(counts, pa.int64())], names=["gram", "count"])


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash in a filter of ``bits`` bits, a power of two."""
    mask = np.uint64(bits - 1)
    return (hashes & mask).astype(np.int64), ((mix(hashes) >> np.uint64(32)) & mask).astype(np.int64)


def _holds(bloom: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    if bloom is None:
        return np.ones(len(hashes), dtype=bool)
    one, two = _places(hashes, len(bloom) * 8)
    bit = lambda at: (bloom[at >> 3] >> (at & 7).astype(np.uint8)) & 1
    return (bit(one) & bit(two)).astype(bool)


def _filter(phrases: DataFrame) -> np.ndarray:
    """Bloom filter of (lang, phrase, words), put together from bitmaps of 4 KB."""
    stored = materialise(phrases.select("lang", "phrase", "words"), "phrase-filter")
    bits = BITMAP_BITS
    size = stored.count()
    while bits < 16 * size and bits < MOST_BITS:
        bits *= 2

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            total = pd.util.hash_array(batch.column("lang").to_numpy(zero_copy_only=False), categorize=False)
            words = batch.column("words").to_numpy(zero_copy_only=False)
            split = [p.split(" ") for p in batch.column("phrase").to_pylist()]
            for i in range(int(words.max())):
                some = np.flatnonzero(words > i)
                own = pd.util.hash_array(np.array([split[j][i] for j in some], dtype=object), categorize=False)
                total[some] = total[some] * np.uint64(0xD1342543DE82EF95) + own
            places = np.concatenate(_places(mix(total + words.astype(np.uint64)), bits))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(places) + 1, pa.int64())], names=["place"])

    place: Column = F.col("place")
    maps = (
        map_arrow(stored, hashed, "place long")
        .groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))
    )
    bloom = np.zeros(bits // 8, np.uint8)
    for bucket, bitmap in maps.collect():  # MOST_BITS bounds them
        low = (bucket - 1) * (BITMAP_BITS // 8)
        bloom[low : low + len(bitmap)] = np.frombuffer(bitmap, np.uint8)
    return bloom
