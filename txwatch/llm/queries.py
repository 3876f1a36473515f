"""The registered queries of this subpackage and their SQL.

Each query applies its operator with production parameters to the whole table
and derives the digest columns from the operator's real output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch.llm import bpe, exact_dedup, html_extract, license_scan, lm_score, ngram_join, packing, quality_rules, sharding, substring_dedup, token_align, vector_codes, warc_zip
from txwatch.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def vocabulary(name: str) -> str:
    """The place of a public tokenizer file, the same on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_substring_dedup", """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
lows AS (SELECT win, min(doc_id) AS low FROM windows GROUP BY win HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos
  FROM windows JOIN lows USING (win) WHERE low < doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w)
  ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op2_warc", """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_zip.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_RULES_SQL = {r: f"CASE WHEN {below} > 0 THEN {above} / {below} ELSE 0.0 END"
              for r, (above, below) in quality_rules.RULES.items()}


def _quality_sql() -> str:
    q = quality_rules
    share = q.ALPHA / len(q.RULES)
    tests = [f"count(*) FILTER (WHERE {v} >= {c}) AS {r}_{i}" for r, v in _RULES_SQL.items() for i, c in enumerate(q.GRID)]
    rows = [f"SELECT lang, n, level, '{r}' AS rule, {c} AS cutoff, {r}_{i} AS k FROM counts"
            for r in q.RULES for i, c in enumerate(q.GRID)]
    return f"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents),
grams AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
          FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
repeated AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS pos FROM grams
    SEMI JOIN (SELECT doc_id, g FROM grams GROUP BY ALL HAVING count(*) > 1) USING (doc_id, g))
  GROUP BY doc_id),
m AS (
  SELECT doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(regexp_extract_all(text, '\\p{{Lu}}')) AS BIGINT) AS n_upper,
         CAST(len(regexp_extract_all(text, '!')) AS BIGINT) AS n_shouts
  FROM w LEFT JOIN repeated USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
counts AS (
  SELECT lang, count(*) AS n, {q.DELTA} / (count(*) OVER () * {len(q.RULES)}) AS level, {', '.join(tests)}
  FROM f SEMI JOIN (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1) USING (doc_id)
  WHERE NOT base_failed GROUP BY lang),
long AS ({' UNION ALL '.join(rows)}),
terms AS (SELECT lang, n, level, rule, cutoff, k, unnest(range(0, k + 1)) AS i FROM long WHERE k < n * {share}),
passed AS (
  SELECT lang, rule, cutoff FROM terms GROUP BY lang, rule, cutoff, level
  HAVING sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share}) + (n - i) * ln(1 - {share}))) <= level),
failed AS (SELECT lang, rule, max(cutoff) AS cutoff FROM (SELECT lang, rule, cutoff FROM long EXCEPT SELECT * FROM passed)
           GROUP BY lang, rule),
best AS (SELECT p.lang, p.rule, min(p.cutoff) AS cut FROM passed p
         LEFT JOIN failed x ON p.lang IS NOT DISTINCT FROM x.lang AND p.rule = x.rule
         WHERE x.cutoff IS NULL OR p.cutoff > x.cutoff GROUP BY p.lang, p.rule),
cuts AS (SELECT lang, {', '.join(f"max(cut) FILTER (WHERE rule = '{r}') AS cut_{r}" for r in q.RULES)} FROM best GROUP BY lang)
SELECT f.doc_id, {', '.join('f.' + c for c in q.COUNTS)}, base_failed,
       NOT base_failed AND NOT ({' OR '.join(f'coalesce({v} >= cut_{r}, false)' for r, v in _RULES_SQL.items())}) AS kept
FROM f LEFT JOIN cuts ON f.lang IS NOT DISTINCT FROM cuts.lang
"""


@query("op3_quality_rules", _quality_sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _license_sql() -> str:
    q = license_scan
    phrases, grams = [], []  # found word for word; found in part
    for base, texts in (("true", q.PHRASES), ("false", q.NOTICES)):
        for text, label in texts.items():
            w = text.split()
            phrases.append(f"('{text}', '{label}', {base}, {len(w)})")
            if base == "false" and len(w) >= q.WHOLE_BELOW:
                grams += [f"('{text}', '{label}', {len(w)}, {t}, {q.telling(text, label)}, '{' '.join(w[t:t + q.LONG])}')" for t in range(len(w) - q.LONG + 1)]
    sizes = sorted({len(t.split()) for t in (*q.PHRASES, *q.NOTICES)})
    grow = f"CAST(floor(size * {q.MAX_STRETCH - 1}) AS BIGINT)"
    return f"""
WITH phrases(template, label, base, size) AS (VALUES {', '.join(phrases)}),
grams(template, label, size, t, must, gram) AS (VALUES {', '.join(grams)}),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents),
firsts AS (SELECT DISTINCT split_part(template, ' ', 1) AS word FROM phrases),
windows AS (
  SELECT doc_id, i - 1 AS pos, n, array_to_string(ws[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, ws, i, unnest({sizes}) AS n FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)
        SEMI JOIN firsts ON ws[i] = word) WHERE i + n - 1 <= len(ws)),
alone AS (SELECT doc_id, template, label, base, pos AS start FROM windows JOIN phrases ON phrase = template AND n = size),
rolled AS (SELECT doc_id, i - 1 AS pos, array_to_string(ws[i:i + {q.LONG - 1}], ' ') AS gram
           FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {q.LONG - 2})) AS i FROM w)),
hits AS (SELECT DISTINCT doc_id, template, label, size, t, must, pos, pos - t AS diag FROM rolled JOIN grams USING (gram)),
diags AS (SELECT doc_id, template, size, diag FROM hits GROUP BY ALL HAVING count(*) < size - {q.LONG - 1}),
jumps AS (SELECT *, diag - lag(diag) OVER (PARTITION BY doc_id, template ORDER BY diag) > {q.GAP} AS jump FROM diags),
runs AS (SELECT *, sum(CASE WHEN jump THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, template ORDER BY diag) AS run FROM jumps),
parts AS (SELECT doc_id, template, diag, run, cut, (diag - min(diag) OVER (PARTITION BY doc_id, template, run) + cut * ({grow} // 2)) // {grow} AS stretch
          FROM runs, (VALUES (0), (1)) AS cuts(cut)),
covers AS (SELECT doc_id, template, label, size, run, cut, stretch, min(pos) AS first, max(pos + {q.LONG - 1}) AS last,
           bool_or(t = must) AS told, count(DISTINCT word) AS n
           FROM (SELECT *, unnest(range(t, t + {q.LONG})) AS word FROM hits) JOIN parts USING (doc_id, template, diag)
           GROUP BY doc_id, template, label, size, run, cut, stretch),
found AS (
  SELECT doc_id, label, base, CASE WHEN base THEN start END AS start, 1.0 AS covered FROM alone UNION ALL
  SELECT doc_id, label, false, NULL, n / size FROM covers
  WHERE told AND n / size >= {q.MIN_COVERED} AND last - first + 1 <= {q.MAX_STRETCH} * size)
SELECT w.doc_id, CAST(any_value(len(ws)) AS BIGINT) AS n_words, count(start) AS n_base,
       CAST(min(start) AS BIGINT) AS first_word, CAST(max(start) AS BIGINT) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       CAST(coalesce(max(covered), 0) AS DOUBLE) AS score
FROM w LEFT JOIN found USING (doc_id) GROUP BY w.doc_id
"""


@query("op4_license_scan", _license_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op5_lm_scoring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scores(table(spark, sf_dir, "documents"))


@query("op6_html_extraction")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    found = bpe.decode_ids(bpe.encode_texts(table(spark, sf_dir, "documents"), path), path)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op8_ngram_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.ngram_join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_copies")


@query("op9_exact_dedup", """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                        value=F.crc32("ids").alias("ids_crc32"))


def _codes_sql() -> str:
    q = vector_codes
    steps = []
    for r in range(q.ROUNDS + 1):
        steps.append(f"""a{r} AS (
  SELECT row, p, x, arg_min(entry, d * 256 + entry) AS entry, min(d) AS d FROM (
    SELECT row, x.p, x, entry, CAST(list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c) AS BIGINT) AS d
    FROM x JOIN c{r} ON x.p = c{r}.p) GROUP BY row, p, x)""")
        if r < q.ROUNDS:
            steps.append(f"""c{r + 1} AS (
  SELECT c{r}.p, c{r}.entry, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (
    SELECT p, entry, list(v ORDER BY i) AS c FROM (
      SELECT p, entry, i, floor(sum(v) / count(*)) AS v
      FROM (SELECT p, entry, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY p, entry, i)
    GROUP BY p, entry) m ON c{r}.p = m.p AND c{r}.entry = m.entry)""")
    return f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS row,
         list_transform(embedding, lambda e: floor({q.SCALE} * CAST(e AS DOUBLE))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS MATERIALIZED (SELECT row, p, v[p * (len(v) // {q.PARTS}) + 1:(p + 1) * (len(v) // {q.PARTS})] AS x
      FROM k, (SELECT unnest(range({q.PARTS})) AS p)),
c0 AS (SELECT p, row - 1 AS entry, x AS c FROM x WHERE row <= {q.ENTRIES}),
{', '.join(s.replace(' AS (', ' AS MATERIALIZED (', 1) for s in steps)},
books AS (SELECT sha256(string_agg(s, ',' ORDER BY p, entry)) AS codebooks_sha256
          FROM (SELECT p, entry, array_to_string(list_transform(c, lambda e: CAST(CAST(e AS BIGINT) AS VARCHAR)), ',') AS s FROM c{q.ROUNDS})),
coded AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
          FROM a{q.ROUNDS} GROUP BY row)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM k JOIN coded USING (row), books
"""


@query("op11_vector_codes", _codes_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = vector_codes.fit(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(codes.frame).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codes.sha256()).alias("codebooks_sha256"))


def _crc32_sql(text: str) -> str:
    """The CRC-32 of a text's bytes, one table step a byte."""
    steps = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        steps.append(byte)
    found = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {found}), "
            f"lambda c, b: xor(({steps}::BIGINT[])[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)")


def _shard_sql() -> str:
    q = sharding
    dims, bits = len(q.DIMS), q.BITS
    scales = [f"""s{i} AS (SELECT {d} AS v, (sum(count(*)) OVER (ORDER BY {d} NULLS FIRST) - count(*)) * {1 << bits} // (SELECT count(*) FROM documents) AS x{i}
      FROM documents GROUP BY {d})""" for i, d in enumerate(q.DIMS)]
    joins = " ".join(f"JOIN s{i} ON d.{d} IS NOT DISTINCT FROM s{i}.v" for i, d in enumerate(q.DIMS))
    xs = [f"x{i}" for i in range(dims)]
    steps, last = [], "rows"

    def step(exprs: dict[str, str]) -> None:
        nonlocal last
        keep = ", ".join(f"{exprs.get(c, c)} AS {c}" for c in (*xs, "turn"))
        steps.append(f"t{len(steps)} AS (SELECT doc_id, size, crc, {keep} FROM {last})")
        last = f"t{len(steps) - 1}"

    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        step({"x0": f"xor(x0, CASE WHEN (x0 >> {b}) & 1 = 1 THEN {low} ELSE 0 END)"})
        for x in xs[1:]:
            swap = f"(CASE WHEN ({x} >> {b}) & 1 = 1 THEN 0 ELSE xor(x0, {x}) & {low} END)"
            step({"x0": f"xor(x0, CASE WHEN ({x} >> {b}) & 1 = 1 THEN {low} ELSE {swap} END)", x: f"xor({x}, {swap})"})
    for a, b in zip(xs, xs[1:]):
        step({b: f"xor({b}, {a})"})
    for b in range(bits - 1, 0, -1):
        step({"turn": f"xor(turn, CASE WHEN ({xs[-1]} >> {b}) & 1 = 1 THEN {(1 << b) - 1} ELSE 0 END)"})
    step({x: f"xor({x}, turn)" for x in xs})
    curve = " + ".join(f"(({x} >> {b}) & 1) * {1 << (dims * b + dims - 1 - i)}" for b in range(bits) for i, x in enumerate(xs))
    return f"""
WITH {', '.join(scales)},
rows AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size, {_crc32_sql("coalesce(text, '')")} AS crc,
         {', '.join(f'CAST({x} AS BIGINT) AS {x}' for x in xs)}, CAST(0 AS BIGINT) AS turn FROM documents d {joins}),
{', '.join(steps)},
ranks AS (SELECT doc_id, size, crc, row_number() OVER (ORDER BY {curve}, doc_id, size, crc) - 1 AS rank FROM {last}),
cuts AS (SELECT *, (SELECT count(*) FROM documents) // {q.SHARDS} AS small, (SELECT count(*) FROM documents) % {q.SHARDS} AS more FROM ranks),
shards AS (SELECT *, CASE WHEN rank < more * (small + 1) THEN rank // (small + 1)
                          ELSE more + (rank - more * (small + 1)) // greatest(small, 1) END AS shard FROM cuts)
SELECT doc_id, size, CAST(crc AS BIGINT) AS text_crc32, '{q.LAW}' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(rank - shard * small - least(shard, more) AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM shards
"""


@query("op12_hilbert_shards", _shard_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.cross_align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                                   vocabulary("piece_bpe_32k.model"))
