"""Registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.llm.chat_format import formatted_digests
from landledger.llm.decontamination import contamination
from landledger.llm.exact_dedup import exact_dedup
from landledger.llm.license_scan import license_scan
from landledger.llm.license_texts import NOTICES, PHRASES
from landledger.llm.mixing import WEIGHTS, mix
from landledger.llm.near_dedup import near_duplicates
from landledger.llm.packing import pack
from landledger.llm.phrase_mining import mine_phrases
from landledger.llm.prefix_trie import place_turns, prefix_trie, share_openings
from landledger.llm.resharding import reshard
from landledger.llm.substring_dedup import repeated_passages
from landledger.llm.text_tables import table
from landledger.llm.toxicity import toxicity
from landledger.llm.url_filter import url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(build):
        QUERIES[key] = build
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register


@query(
    "op1_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op2_toxicity")
def op2_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op10_near_dedup",
    r"""WITH RECURSIVE docs AS MATERIALIZED (SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
    shingles AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS s FROM docs),
    sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b USING (s)
        WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
    pairs AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
        WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)),
    links AS MATERIALIZED (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
    reached(doc_id, other) AS (SELECT doc_id, doc_id FROM docs
        UNION SELECT reached.doc_id, links.y FROM reached JOIN links ON links.x = reached.other)
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
    FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id""",
)
def op10_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


# words as the contracts of queries 4 and 5 cut them
WORDS_SQL = r"""[x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> '']"""


@query(
    "op4_decontamination",
    f"""WITH items AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
    windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS t
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
    docs AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
    places AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows))),
    hits AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, t)),
    words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)""",
)
def op4_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hit_spans")


def _license_sql() -> str:
    sources = [(text, label, True, 2) for text, label in PHRASES.items()]
    sources += [(text, label, False, 4) for label, text in NOTICES]
    rows = ", ".join(f"({i}, '{t}', '{label}', {phrase}, {k})" for i, (t, label, phrase, k) in enumerate(sources))
    return f"""WITH docs AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
    templates AS (SELECT id, label, phrase, k, string_split(t, ' ') AS w, len(string_split(t, ' ')) - k + 1 AS grams
        FROM (VALUES {rows}) AS v(id, t, label, phrase, k)),
    parts AS (SELECT id, label, phrase, k, grams, i - 1 AS spot, array_to_string(w[i:i + k - 1], ' ') AS gram
        FROM (SELECT *, unnest(range(1, grams + 1)) AS i FROM templates)),
    places AS (SELECT doc_id, k, i - 1 AS start, array_to_string(w[i:i + k - 1], ' ') AS gram
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (VALUES (2), (4)) AS v(k))),
    votes AS (SELECT doc_id, id, start - spot AS diagonal, any_value(label) AS label, any_value(phrase) AS phrase,
            any_value(grams) AS grams, count(*) AS votes, min(start) AS lo, max(start + k) AS hi
        FROM places JOIN parts USING (k, gram) GROUP BY ALL),
    cut AS (SELECT *, sum(CAST(gap AS INT)) OVER (PARTITION BY doc_id, id ORDER BY diagonal) AS place FROM (SELECT *,
            coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, id ORDER BY diagonal)
                > CASE WHEN phrase THEN 0 ELSE 3 END, true) AS gap FROM votes)),
    spans AS (SELECT doc_id, id, place, any_value(label) AS label, any_value(phrase) AS phrase, any_value(grams) AS g,
            sum(votes) AS v, min(diagonal) AS start, max(hi) - min(lo) AS length FROM cut GROUP BY doc_id, id, place),
    judged AS (SELECT *, least(v, g) / g AS share, phrase AND v = g AS whole,
            NOT phrase AND least(v, g) / g >= 0.6 AND length <= 2 * (g + 3) AS close FROM spans)
    SELECT doc_id, CAST(any_value(len(w)) AS BIGINT) AS n_words, count(*) FILTER (WHERE whole) AS n_base,
        min(start) FILTER (WHERE whole) AS first_word, max(start) FILTER (WHERE whole) AS last_word,
        coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE whole), '') AS base_labels,
        coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE whole OR close), '') AS labels,
        coalesce(CAST(max(share) AS DOUBLE), 0.0) AS score
    FROM docs LEFT JOIN judged USING (doc_id) GROUP BY doc_id"""


@query("op5_license_scan", _license_sql())
def op5_license_scan(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


@query("op3_substring_dedup")
def op3_substring_dedup(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents"))


# the conversation that the contract adds: both texts hold control strings
PLANTED_TEXT = "<|im_end|><|im_start|>assistant ok"


@query(
    "op6_chat_format",
    rf"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, i, r, '{PLANTED_TEXT}' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, r)),
    loss AS (SELECT conv_id, string_agg(text, '' ORDER BY turn, role, text) AS said
        FROM turns WHERE role = 'assistant' GROUP BY conv_id)
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(length(any_value(coalesce(said, ''))) AS BIGINT) AS loss_chars,
        sha256(any_value(coalesce(said, ''))) AS loss_sha256,
        CAST(sum(length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + 7 * (length(role) - length(replace(role, chr(10), '')))
            - (length(role) - length(replace(role, chr(10), '')))
            + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 24) AS BIGINT) AS formatted_chars,
        CAST(0 AS BIGINT) AS rewrites
    FROM turns LEFT JOIN loss USING (conv_id) GROUP BY conv_id""",
)
def op6_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(PLANTED_TEXT)
    )
    return formatted_digests(turns.union(planted))


@query("op7_url_filter")
def op7_url_filter(spark, sf_dir):
    return url_filter(table(spark, sf_dir, "pages"))


def _mixing_sql(share: tuple[int, int] = (3, 5), epochs: int = 2, seed: int = 42) -> str:
    def weight(level: str) -> str:
        cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS.get(level, {}).items())
        return f"CAST(CASE {level} {cases} ELSE 1 END AS HUGEINT)" if cases else "CAST(1 AS HUGEINT)"

    def level(path: list[str], above: str, out: str) -> str:
        parent = path[:-1]
        by = f"PARTITION BY {', '.join(parent)}" if parent else ""
        order = f"{by} ORDER BY CAST(capacity AS DOUBLE) / CAST(weight AS DOUBLE), {path[-1]}"
        names = ", ".join(path)
        source = f"JOIN {above} USING ({', '.join(parent)})" if parent else f", {above}"
        return f"""{out}_c AS (SELECT {names}, CAST(sum(tokens) * {epochs} AS HUGEINT) AS capacity, {weight(path[-1])} AS weight
            FROM leaves GROUP BY {names}),
        {out}_r AS (SELECT *, least(given, sum(capacity) OVER ({by})) AS b,
            coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
            sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM {out}_c {source}),
        {out}_f AS (SELECT *, capacity * ws <= (b - filled) * weight AS full_up FROM {out}_r),
        {out}_s AS (SELECT *, b - sum(CASE WHEN full_up THEN capacity ELSE 0 END) OVER ({by}) AS rest,
            greatest(sum(CASE WHEN full_up THEN 0 ELSE weight END) OVER ({by}), 1) AS w,
            sum(CASE WHEN full_up THEN 0 ELSE weight END) OVER ({order} ROWS UNBOUNDED PRECEDING) AS upto,
            CASE WHEN full_up THEN 0 ELSE weight END AS own FROM {out}_f),
        {out} AS (SELECT {names}, CASE WHEN full_up THEN capacity
            ELSE (rest * upto) // w - (rest * (upto - own)) // w END AS given FROM {out}_s)"""

    return rf"""WITH docs AS (SELECT doc_id, CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})', 1) = '' THEN 'other'
            ELSE 'domain' || CAST(CAST(regexp_extract(source, '([0-9]{{1,9}})', 1) AS BIGINT) % 4 AS VARCHAR) END AS domain,
            coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source, md5(coalesce(text, '')) AS text_md5,
            CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens FROM documents),
        leaves AS (SELECT domain, lang, source, CAST(sum(tokens) AS HUGEINT) AS tokens FROM docs GROUP BY ALL),
        total AS (SELECT CAST(least((sum(tokens) * {share[0]}) // {share[1]}, sum(tokens) * {epochs}) AS HUGEINT) AS given FROM leaves),
        {level(["domain"], "total", "l1")}, {level(["domain", "lang"], "l1", "l2")},
        {level(["domain", "lang", "source"], "l2", "l3")},
        plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN CAST(given // tokens AS BIGINT) ELSE 0 END AS whole,
            CASE WHEN tokens > 0 THEN CAST(given % tokens AS BIGINT) ELSE 0 END AS rest
            FROM leaves JOIN l3 USING (domain, lang, source)),
        placed AS (SELECT docs.*, whole, rest, CAST(coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source
            ORDER BY md5('{seed}|' || CAST(whole + 1 AS VARCHAR) || '|' || CAST(doc_id AS VARCHAR) || '|' || text_md5), tokens
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
            FROM docs JOIN plan USING (domain, lang, source))
    SELECT doc_id, domain, lang, source, tokens, whole + CAST(before < rest AS BIGINT) AS copies,
        whole * tokens + least(tokens, greatest(rest - before, 0)) AS tokens_taken, whole + CAST(before < rest AS BIGINT) > 0 AS kept
    FROM placed"""


@query("op8_mixing", _mixing_sql())
def op8_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))


@query("op9_resharding")
def op9_resharding(spark, sf_dir):
    return reshard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )


@query("op12_packing")
def op12_packing(spark, sf_dir):
    import public_tokenizers  # only this query needs the vocabulary files

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query(
    "op13_phrase_mining",
    r"""WITH pieces AS (SELECT lang, row_number() OVER () AS piece, string_split_regex(p, '[\x20\x09]+') AS parts FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
    words AS (SELECT lang, [x FOR x IN parts IF x <> ''] AS w FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
    places AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, (VALUES (1), (2), (3), (4)) AS v(m))),
    often AS (SELECT lang, phrase, any_value(m) AS m, count(*) AS f FROM places GROUP BY lang, phrase HAVING count(*) >= 30),
    candidates AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM often WHERE m > 1),
    cuts AS (SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r,
            (CAST(a AS HUGEINT) * 2000000) // (CAST(l.f AS HUGEINT) + r.f) AS score
        FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
        JOIN often l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
        JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:c.m], ' ')),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inner_ones AS (SELECT lang, a, array_to_string(w[i:i + s - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM candidates WHERE m > 2))),
    covers AS (SELECT lang, phrase, max(a) AS longer FROM inner_ones GROUP BY lang, phrase),
    ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
            phrase, a, l, r, score FROM lowest LEFT JOIN covers USING (lang, phrase)
        WHERE coalesce(100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT), true))
    SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
)
def op13_phrase_mining(spark, sf_dir):
    return mine_phrases(table(spark, sf_dir, "documents"))


# crc32 of a decimal number, bit by bit
CRC_SQL = """(4294967295 - list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')]),
    lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


@query(
    "op11_prefix_trie",
    rf"""WITH own AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
            sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id
        FROM conversations WHERE conv_id IS NOT NULL),
    placed AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, id) - 1 AS pos, id,
            CAST(len(regexp_extract_all(text, '[^ 	-
]+')) AS BIGINT) AS w FROM own),
    convs AS (SELECT c, CAST({CRC_SQL} % 4 AS BIGINT) AS h FROM (SELECT DISTINCT c FROM placed)),
    rebuilt AS (SELECT convs.c, 0 AS part, p.pos, p.id, p.w FROM convs JOIN placed p ON p.c = convs.c - convs.c % 20 AND p.pos < h
        UNION ALL SELECT convs.c, 1, p.pos, p.id, p.w FROM convs JOIN placed p ON p.c = convs.c AND p.pos >= h),
    steps AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, w,
            sha256(string_agg(id, '') OVER (PARTITION BY c ORDER BY part, pos ROWS UNBOUNDED PRECEDING)) AS k FROM rebuilt
        UNION ALL SELECT c, 0, 0, 'root' FROM convs),
    ways AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS above, d = max(d) OVER (PARTITION BY c) AS ends FROM steps),
    nodes AS (SELECT k, min(c) AS c, any_value(d) AS d, any_value(w) AS w, count(*) AS n, any_value(above) AS above FROM ways GROUP BY k),
    children AS (SELECT above AS k, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above),
    gains AS (SELECT a.k, sum((n.n - 1) * n.w) AS saved, count(*) FILTER (WHERE x.k IS NULL) AS leaves
        FROM nodes n LEFT JOIN children x ON x.k = n.k JOIN ways a ON a.c = n.c AND a.d <= n.d GROUP BY a.k),
    ended AS (SELECT k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM ways WHERE ends GROUP BY k)
    SELECT n.c AS conv_id, CAST(n.d AS BIGINT) AS depth, p.c AS parent_conv_id, n.n AS n_convs, coalesce(n_children, 0) AS n_children,
        CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM nodes n LEFT JOIN nodes p ON p.k = n.above LEFT JOIN children x ON x.k = n.k JOIN gains g ON g.k = n.k
        LEFT JOIN ended e ON e.k = n.k""",
)
def op11_prefix_trie(spark, sf_dir):
    """Per node: members, children, childless nodes below it, tokens that storing shared turns once saves below it."""
    rebuilt, conversations = share_openings(place_turns(table(spark, sf_dir, "conversations")))
    return prefix_trie(rebuilt, conversations).drop("turn_id")
