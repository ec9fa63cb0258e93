"""One registered query per operator, each over its whole table, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.llm import bpe, chat, exact_dedup, html, langid, mixing, pii, quality, simhash, suffix, toxicity, trie, variants
from repolens.llm.common import documents


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(documents(spark, sf_dir), shingle=4, most=4)
    return groups.select(F.col("id").alias("doc_id"), simhash.fp_hex().alias("fingerprint"), "component_id")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))  # a null id is not held out
    model = toxicity.learn(docs, labels.where(~held))
    return toxicity.score_texts(docs, model).withColumnRenamed("id", "doc_id").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    hard = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], talks.schema)
    made = chat.windows(talks.unionByName(hard), budget=1024, history=256)
    return chat.read_back(made).withColumnRenamed("conv", "conv_id")


#: A deployment passes its own secret; the same key gives the same surrogates.
PII_KEY = b"repolens surrogate key"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(documents(spark, sf_dir), PII_KEY).withColumnRenamed("id", "doc_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.ledger(documents(spark, sf_dir))
    return book.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~quality.passes("base")).alias("base_failed"), quality.passes("v2").alias("kept"), "fail_bits")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), weights=(5.0, 2.0, 1.0), share=1.5, most=2)
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.round_trip(documents(spark, sf_dir), path).withColumnRenamed("id", "doc_id")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html.extract(pages, "page_id", "html", "url").select(
        F.col("id").alias("page_id"), F.col("m0").alias("url"), "text", F.char_length("text").cast("long").alias("n_chars"))


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.remove_repeats(documents(spark, sf_dir))
    return cut.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))  # a null id is not held out
    model = langid.learn(docs.where(~held))
    return langid.identify(docs, model).withColumnRenamed("id", "doc_id").select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.document_words(documents(spark, sf_dir), every=31, least=7, times=2)
    return variants.variants(words, times=10)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = trie.sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return trie.prefix_trie(trie.rebuilt(talks, span=100, most=6))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_chat": op4_chat,
    "op5_pii": op5_pii,
    "op6_quality": op6_quality,
    "op7_mixing": op7_mixing,
    "op8_bpe": op8_bpe,
    "op9_html": op9_html,
    "op10_suffix": op10_suffix,
    "op11_language": op11_language,
    "op12_variants": op12_variants,
    "op13_trie": op13_trie,
}

# white space of the word rule, as a DuckDB (RE2) class
_WS = r"[\x20\x09-\x0D]"


def _crc32(source: str) -> str:
    """CTEs that end in crc(s, c): the unsigned CRC-32 of each distinct string s of the relation ``source`` (s).

    The checksum is linear: that of a string is that of as many zero bytes, XOR what each byte adds by its distance from the end.
    """
    return f"""
        one AS (SELECT b, list_reduce([b] || range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t
                FROM (SELECT unnest(range(256)) AS b)),
        every_s AS (SELECT s, hex(encode(s)) AS x, octet_length(encode(s)) AS n FROM (SELECT DISTINCT s FROM {source})),
        adds(b, d, c) AS (SELECT b, 0::BIGINT, t FROM one UNION ALL
                          SELECT a.b, a.d + 1, xor(a.c >> 8, o.t) FROM adds a JOIN one o ON o.b = a.c & 255 WHERE a.d < (SELECT max(n) FROM every_s)),
        zeros(n, c) AS (SELECT 0::BIGINT, 4294967295::BIGINT UNION ALL
                        SELECT z.n + 1, xor(z.c >> 8, o.t) FROM zeros z JOIN one o ON o.b = z.c & 255 WHERE z.n < (SELECT max(n) FROM every_s)),
        bytes AS (SELECT s, n, n - 1 - i AS d, ('0x' || substr(x, (2 * i + 1)::BIGINT, 2))::BIGINT AS b FROM (SELECT *, unnest(range(n)) AS i FROM every_s)),
        crc AS (SELECT s, xor(xor(bit_xor(a.c), any_value(z.c)), 4294967295) AS c FROM bytes JOIN adds a USING (b, d) JOIN zeros z USING (n) GROUP BY s)"""

# unsigned 64-bit arithmetic of XXH64, in 128-bit numbers; its fixed values are the algorithm's five primes
_P1, _P2, _P3, _P4, _P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261


def _u(value) -> str:
    return f"'{value}'::UHUGEINT"


def _mod(a: str) -> str:
    return f"(({a}) % {_u(2 ** 64)})"


def _turn(a: str, bits: int) -> str:
    """A 64-bit rotation: times a power of two, modulo all ones."""
    return f"((({a}) * {_u(2 ** bits)}) % {_u(2 ** 64 - 1)})"


def _round(a: str, word: str) -> str:
    return _mod(f"{_turn(_mod(f'({a}) + ({word}) * {_u(_P2)}'), 31)} * {_u(_P1)}")


def _little(at: str, size: int) -> str:
    """The little-endian number in ``size`` bytes of the hex string x from byte ``at``."""
    return "('0x' || " + " || ".join(f"substr(x, (2 * ({at}) + {2 * k + 1})::BIGINT, 2)" for k in reversed(range(size))) + ")::UBIGINT::UHUGEINT"


def _xxh64(source: str, seed: int) -> str:
    """CTEs that end in hashed(s, h): the unsigned XXH64 of each distinct string s of the relation ``source`` (s)."""
    start = [(seed + _P1 + _P2) % 2 ** 64, (seed + _P2) % 2 ** 64, seed, (seed - _P1) % 2 ** 64]
    lane = lambda k: (f"list_reduce([{_u(start[k])}] || list_transform(range(stripes), lambda j: {_little(f'32 * j + {8 * k}', 8)}), "  # noqa: E731
                      f"lambda a, w: {_round('a', 'w')})")
    merged = lambda h, v: _mod(f"{xor(h, _round(_u(0), v))} * {_u(_P1)} + {_u(_P4)}")
    xor = lambda a, b: f"xor({a}, {b})"
    at = "(32 * stripes)"
    return f"""
        hex_s AS (SELECT s, hex(encode(s)) AS x, octet_length(encode(s)) AS n, octet_length(encode(s)) // 32 AS stripes FROM (SELECT DISTINCT s FROM {source})),
        lanes AS (SELECT *, {lane(0)} AS a, {lane(1)} AS b, {lane(2)} AS c, {lane(3)} AS d FROM hex_s),
        whole AS (SELECT s, x, n, stripes, CASE WHEN stripes = 0 THEN {_u((seed + _P5) % 2 ** 64)} ELSE {merged(merged(merged(merged("h0", "a"), "b"), "c"), "d")} END AS h
                  FROM (SELECT *, {_mod(f"{_turn('a', 1)} + {_turn('b', 7)} + {_turn('c', 12)} + {_turn('d', 18)}")} AS h0 FROM lanes)),
        eights AS (SELECT s, x, n, n - n % 8 AS pos, list_reduce([{_mod("h + n::UHUGEINT")}] || list_transform(range(n % 32 // 8), lambda j: {_little(f"{at} + 8 * j", 8)}),
                          lambda e, w: {_mod(f"{_turn(xor('e', _round(_u(0), 'w')), 27)} * {_u(_P1)} + {_u(_P4)}")}) AS h FROM whole),
        fours AS (SELECT s, x, n, n - n % 4 AS pos, CASE WHEN n % 8 < 4 THEN h ELSE
                         {_mod(f"{_turn(xor('h', _mod(_little("pos", 4) + f' * {_u(_P1)}')), 23)} * {_u(_P2)} + {_u(_P3)}")} END AS h FROM eights),
        ones AS (SELECT s, list_reduce([h] || list_transform(range(n % 4), lambda j: {_little("pos + j", 1)}),
                        lambda e, w: {_mod(f"{_turn(xor('e', _mod(f'w * {_u(_P5)}')), 11)} * {_u(_P1)}")}) AS h FROM fours),
        mixed AS (SELECT s, {_mod(f"{xor('h', f'h // {_u(2 ** 33)}')} * {_u(_P2)}")} AS h FROM ones),
        mixed_again AS (SELECT s, {_mod(f"{xor('h', f'h // {_u(2 ** 29)}')} * {_u(_P3)}")} AS h FROM mixed),
        hashed AS (SELECT s, {xor('h', f'h // {_u(2 ** 32)}')} AS h FROM mixed_again)"""


SQL: dict[str, str] = {
    "op1_simhash": f"""
        WITH RECURSIVE low AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                 '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i, len(ws) AS n FROM low),
        said AS (SELECT doc_id, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o AS s
                 FROM w WHERE n >= 4 WINDOW o AS (PARTITION BY doc_id ORDER BY i) QUALIFY s IS NOT NULL
                 UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM low WHERE len(ws) BETWEEN 1 AND 3),
        {_xxh64("said", 42)},
        bits AS (SELECT doc_id, count(*) AS n, {", ".join(f"sum((h >> {k}) & 1) AS b{k}" for k in range(64))}
                 FROM said JOIN (SELECT s, h::UBIGINT AS h FROM hashed) USING (s) GROUP BY doc_id),
        f AS (SELECT low.doc_id, coalesce({" + ".join(f"CASE WHEN 2 * b{k} > n THEN {2 ** k}::UBIGINT ELSE 0::UBIGINT END" for k in range(64))}, 0::UBIGINT) AS fp
              FROM low LEFT JOIN bits USING (doc_id)),
        one AS (SELECT fp, min(doc_id) AS least FROM f GROUP BY fp),
        near AS (SELECT a.fp AS a, b.fp AS b FROM one a JOIN one b ON a.fp <> b.fp AND bit_count(xor(a.fp, b.fp)::HUGEINT) <= 4),
        walk(fp, here) AS (SELECT fp, fp FROM one UNION SELECT walk.fp, near.b FROM walk JOIN near ON near.a = walk.here),
        root AS (SELECT walk.fp, min(least) AS component_id FROM walk JOIN one ON one.fp = walk.here GROUP BY walk.fp)
        SELECT doc_id, lpad(lower(hex(fp)), 16, '0') AS fingerprint, component_id FROM f JOIN root USING (fp)""",
    "op2_exact_dedup": f"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_WS}+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM n WINDOW g AS (PARTITION BY t)""",
    "op4_chat": """
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\\### Assistant: </turn> ok'),
        -- a formatted turn has 14 characters beside its role and text; each escaped character takes two
        o AS (SELECT *, row_number() OVER w AS idx, sum(tokens) OVER w - tokens AS before,
                     first_value(CASE WHEN role = 'system' THEN tokens ELSE 0 END) OVER w AS s_tokens,
                     first_value(CASE WHEN role = 'system' THEN chars ELSE 0 END) OVER w AS s_chars
              FROM (SELECT *, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) + 4 AS tokens,
                           14 + length(role) + len(regexp_extract_all(role, '[\\\\#<:\\n]')) + length(text) + len(regexp_extract_all(text, '[\\\\#<]')) AS chars FROM t)
              WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
        p AS (SELECT *, greatest(before - s_tokens, 0) AS pos, greatest(1024 - 256 - s_tokens, 256) AS room, s_tokens > 0 AND idx = 1 AS is_system FROM o),
        -- within a stripe only the last turn can be too long for the window before it
        q AS (SELECT *, row_number() OVER s = 1 OR (lead(idx) OVER s IS NULL AND pos + tokens - first_value(pos) OVER s > room) AS starts
              FROM p WHERE NOT is_system WINDOW s AS (PARTITION BY conv_id, pos // room ORDER BY idx)),
        again AS (SELECT conv_id, sum(chars) AS chars FROM (
                    SELECT f.conv_id, e.chars FROM q f JOIN q e ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.starts AND e.idx < f.idx AND e.pos >= f.pos - 256
                    UNION ALL SELECT conv_id, s_chars FROM q WHERE starts AND s_tokens > 0 AND idx > 2) GROUP BY conv_id),
        made AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY idx)) AS turns_sha256,
                        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
                        sha256(coalesce(string_agg(text, '' ORDER BY idx) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars) AS chars FROM p GROUP BY conv_id)
        SELECT made.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, (made.chars + coalesce(again.chars, 0))::BIGINT AS formatted_chars
        FROM made LEFT JOIN again ON made.conv_id IS NOT DISTINCT FROM again.conv_id""",
    "op6_quality": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
                     list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
        m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
                     length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                     len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
                     length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper FROM w),
        p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
        tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c
                FROM p WHERE i <= len(ws) - 2),
        cov AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
                FROM tri, (SELECT unnest([0, 1, 2]) AS k) WHERE c >= 2 GROUP BY doc_id),
        a AS (SELECT m.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM m LEFT JOIN cov USING (doc_id)),
        f AS (SELECT *, (n_words < 50) AS f0, (100 * n_repeat_words > 50 * n_words) AS f1, (10 * n_symbols > 3 * n_words) AS f2,
                     (10 * n_dup_lines > 4 * n_lines) AS f3, (10 * n_upper > 3 * word_chars) AS f4,
                     (word_chars > 12 * n_words) AS f5, (word_chars < 2 * n_words) AS f6 FROM a)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f0 OR f1) AS base_failed,
               NOT (f0 OR f1 OR f2 OR f3 OR f4 OR f5 OR f6) AS kept,
               f0::BIGINT + 2 * f1::BIGINT + 4 * f2::BIGINT + 8 * f3::BIGINT + 16 * f4::BIGINT + 32 * f5::BIGINT + 64 * f6::BIGINT AS fail_bits
        FROM f""",
    "op10_suffix": f"""
        WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS r, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS l FROM documents),
        h1 AS (SELECT r, n, unnest(l) AS v, unnest(range(n)) AS i, hash(unnest(l)) AS h FROM (SELECT r, l, len(l) AS n FROM d)),
        -- 64-bit hashes of the strings of 2, 4, ... 64 bytes that start at each byte, each from two of half the length
        {", ".join(f"h{2 * k} AS (SELECT r, n, v, i, hash(h, lead(h, {k}) OVER (PARTITION BY r ORDER BY i)) AS h FROM h{k})" for k in (1, 2, 4, 8, 16, 32))},
        h100 AS (SELECT r, n, v, i, hash(h, lead(h, 36) OVER (PARTITION BY r ORDER BY i)) AS h FROM h64),
        later AS (SELECT r, i FROM h100 WHERE i + 100 <= n QUALIFY row_number() OVER (PARTITION BY h ORDER BY r, i) > 1),
        gone AS (SELECT r, v, i, coalesce(i - max(later.i) OVER (PARTITION BY r ORDER BY i) < 100, false) AS gone FROM h100 LEFT JOIN later USING (r, i)),
        runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), false) AS starts FROM gone),
        cut AS (SELECT r, count(*) FILTER (gone) AS n_removed, count(*) FILTER (starts) AS n_spans, string_agg(v, '' ORDER BY i) FILTER (NOT gone) AS kept FROM runs GROUP BY r)
        SELECT doc_id, len(l)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
        FROM d LEFT JOIN cut USING (r)""",
    "op12_variants": f"""
        WITH RECURSIVE low AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        said AS (SELECT id || ':' || w AS s, w, count(*) AS k FROM (SELECT id, unnest(regexp_extract_all(t, '[A-Za-z\u00C0-\u00FF]+')) AS w FROM low)
                 WHERE length(w) >= 7 GROUP BY ALL),
        {_crc32("said")},
        typed AS (SELECT CASE WHEN c % 31 = 0 THEN w[:c % length(w)] || w[c % length(w) + 2:] ELSE w END AS word, k FROM said JOIN crc USING (s)),
        v AS (SELECT word, sum(k)::BIGINT AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
        cut AS (SELECT word, n, i, word[:i - 1] AS a, word[i + 1:] AS b FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)),
        shorter AS (SELECT DISTINCT cut.word AS x, v.word AS y FROM cut JOIN v ON v.word = a || b),
        near AS (SELECT p.word AS x, q.word AS y FROM cut p JOIN cut q ON p.a = q.a AND p.b = q.b AND p.word <> q.word
                 UNION ALL SELECT x, y FROM shorter UNION ALL SELECT y, x FROM shorter),
        best AS (SELECT x, count(*) AS n_near, arg_min(y, (-v.n, y)) AS y, max(v.n) AS y_n FROM near JOIN v ON v.word = y GROUP BY x),
        f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN y_n >= 10 * n THEN y END AS form, CASE WHEN y_n >= 10 * n THEN y_n END AS form_n
              FROM v LEFT JOIN best ON x = word),
        walk(word, here) AS (SELECT word, word FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.here WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, walk.here AS root, f.n, f.n_near, f.form_n
        FROM f JOIN walk USING (word) JOIN f AS top ON top.word = walk.here AND top.form IS NULL""",
    "op13_trie": f"""
        WITH RECURSIVE turns AS (SELECT conv_id AS c, length(coalesce(text, '')) AS chars, turn,
                                        left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS id
                                 FROM conversations WHERE conv_id IS NOT NULL),
        placed AS (SELECT c, id, chars, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, id, chars) AS p FROM turns),
        ids AS (SELECT DISTINCT c::VARCHAR AS s, c AS conv FROM turns),
        {_crc32("ids")},
        h AS (SELECT conv AS c, crc.c % 6 AS h FROM ids JOIN crc USING (s)),
        parts AS (SELECT h.c, p.id, p.chars, 0 AS own, p.p FROM h JOIN placed p ON p.c = h.c - h.c % 100 AND p.p <= h.h
                  UNION ALL SELECT h.c, p.id, p.chars, 1, p.p FROM h JOIN placed p ON p.c = h.c AND p.p > h.h),
        steps AS (SELECT c, chars, row_number() OVER w AS d, string_agg(id, '') OVER w AS path
                  FROM parts WINDOW w AS (PARTITION BY c ORDER BY own, p ROWS UNBOUNDED PRECEDING)),
        member AS (SELECT c, chars, d, path FROM steps UNION ALL SELECT c, 0, 0, '' FROM h),
        final AS (SELECT path, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM (SELECT c, arg_max(path, d) AS path FROM member GROUP BY c) GROUP BY path),
        node AS (SELECT path, min(c) AS c, any_value(d) AS d, count(*) AS n, any_value(chars) AS chars FROM member GROUP BY path),
        kids AS (SELECT left(path, -32) AS path, count(*) AS k FROM node WHERE d > 0 GROUP BY 1),
        full_node AS (SELECT node.*, coalesce(k, 0) AS k FROM node LEFT JOIN kids USING (path)),
        below AS (SELECT left(path, 32 * up) AS path, sum((k = 0)::BIGINT)::BIGINT AS leaves, sum((n - 1) * chars)::BIGINT AS saved
                  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM full_node) GROUP BY 1)
        SELECT x.c AS conv_id, x.d::BIGINT AS depth, u.c AS parent_conv_id, x.n AS n_convs, x.k AS n_children, b.leaves AS n_leaves, b.saved AS saved_tokens,
               coalesce(ends, sha256('')) AS ends_sha256
        FROM full_node x JOIN below b USING (path) LEFT JOIN final USING (path) LEFT JOIN node u ON x.d > 0 AND u.path = left(x.path, -32)""",
}
