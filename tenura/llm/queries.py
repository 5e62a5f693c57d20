"""Queries of the operators over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm.additive import quality
from tenura.llm.fertility import Fertility, quality_rules
from tenura.llm.langid import identified
from tenura.llm.merkle import FAN, verified_documents
from tenura.llm.minhash import near_duplicates
from tenura.llm.mixing import mix
from tenura.llm.pii import SECRET_BITS, SECRET_DOUBT, SECRET_LEAD, SECRET_PATTERN, iban_pattern, listed, personal_data
from tenura.llm.pivots import PivotClustering, clusters
from tenura.llm.positions import contamination
from tenura.llm.quotations import linked_messages
from tenura.llm.sharding import Sharding, shards
from tenura.llm.texts import shared_folder, table
from tenura.llm.token_files import TokenFiles, token_documents
from tenura.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str):
    def register(build):
        QUERIES[name] = build
        return build

    return register


@query("op10_minhash_near_dedup")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


ORACLES["op10_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words
), shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
meets AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM meets JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
  WHERE 100 * n >= 80 * (len(p.s) + len(q.s) - n)
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM sets UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.r),
roots AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN roots USING (doc_id)
"""


@query("op3_benchmark_decontamination")
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated"
    )


ORACLES["op3_benchmark_decontamination"] = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM bw WHERE len(w) > 0)
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM windows))
), found AS (SELECT doc_id, item_id, i, n FROM places JOIN windows USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


@query("op9_mixing_to_target_weights")
def _(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


ORACLES["op9_mixing_to_target_weights"] = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, size, [1, 2, 3][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM sized GROUP BY 1)
), fill AS (
  SELECT *, CAST((SELECT sum(size) FROM s) - 3 * coalesce(sum(size) OVER lower, 0) AS BIGINT) AS num,
    CAST(sum(w) OVER upper AS BIGINT) AS den, row_number() OVER (ORDER BY size * 1.0 / w, source) AS k
  FROM s WINDOW lower AS (ORDER BY size * 1.0 / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    upper AS (ORDER BY size * 1.0 / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (SELECT k, num, den FROM fill WHERE w * num <= 3 * size * den ORDER BY k LIMIT 1),
targets AS (
  SELECT fill.source, fill.size AS source_size,
    CASE WHEN fill.k < level.k THEN CAST(3 * fill.size AS DOUBLE) ELSE CAST(w AS DOUBLE) * (CAST(level.num AS DOUBLE) / CAST(level.den AS DOUBLE)) END AS target
  FROM fill, level
), cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS repeats FROM targets
), placed AS (
  SELECT sized.*, source_size, target, repeats, target - repeats * source_size AS r,
    sum(size) OVER (PARTITION BY sized.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum(size) OVER (PARTITION BY sized.source, h) AS own
  FROM sized JOIN cut ON sized.source IS NOT DISTINCT FROM cut.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  CAST(size * (repeats + CASE WHEN 2 * upto - own <= 2 * r THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""


@query("op4_token_id_output")
def _(spark: SparkSession, folder: str) -> DataFrame:
    how = TokenFiles(public_tokenizers.path("word_bpe_49k.json"))
    return token_documents(table(spark, folder, "documents"), shared_folder(spark, "token-files"), how)


@query("op5_tokeniser_fertility")
def _(spark: SparkSession, folder: str) -> DataFrame:
    how = Fertility(public_tokenizers.path("piece_bpe_32k.model"))
    return quality_rules(table(spark, folder, "documents"), how, table(spark, folder, "labels")).drop("row")


@query("op8_pii")
def _(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data(table(spark, folder, "documents"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}")
        for kind in ("email", "ip", "card", "phone")
    ]
    return found.select(
        "doc_id", *counts, F.sha2(listed("spans", base_only=True), 256).alias("base_sha256"),
        listed("spans", base_only=False).alias("spans"), F.size("spans").cast("bigint").alias("n_spans"),
    )


def _span_sql(kind: str, pattern: str, valid: str) -> str:
    return rf"""
  SELECT doc_id, '{kind}' AS kind, m, CAST(list_sum(list_transform(p[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(all_m[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS a, t
  FROM (SELECT doc_id, t, p, all_m, i, all_m[i] AS m FROM (
    SELECT doc_id, t, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}') AS all_m FROM texts
  ), unnest(range(1, len(all_m) + 1)) AS u(i)) WHERE {valid}"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = (
    "list_sum(list_transform(range(1, len({d}) + 1), lambda k: CASE WHEN (len({d}) - k) % 2 = 1 THEN "
    "CASE WHEN 2 * CAST(({d})[k] AS INT) > 9 THEN 2 * CAST(({d})[k] AS INT) - 9 ELSE 2 * CAST(({d})[k] AS INT) END "
    "ELSE CAST(({d})[k] AS INT) END)) % 10 = 0"
).format(d=_DIGITS)
_TURNED = "replace(m, ' ', '')[5:] || replace(m, ' ', '')[1:4]"
_MOD97 = (
    f"list_reduce(list_transform(string_split({_TURNED}, ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN CAST(c AS BIGINT) "
    "ELSE CAST(ascii(c) - 55 AS BIGINT) END), lambda r, v: (r * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97, CAST(0 AS BIGINT)) = 1"
)
_ENTROPY = (
    "log2(len(m)) - list_sum(list_transform(list_distinct(string_split(m, '')), "
    "lambda c: (len(m) - len(replace(m, c, ''))) * log2(len(m) - len(replace(m, c, ''))))) / len(m)"
)
ORACLES["op8_pii"] = (
    "WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), found AS ("
    + " UNION ALL ".join([
        _span_sql("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
        _span_sql("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "list_max(list_transform(string_split(m, '.'), lambda x: CAST(x AS HUGEINT))) <= 255"),
        _span_sql("card", r"[0-9](?:[\x20-]?[0-9])+", f"len({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}"),
        _span_sql("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"len({_DIGITS}) BETWEEN 9 AND 15"),
        _span_sql("iban", iban_pattern(), _MOD97),
        _span_sql("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "NOT regexp_matches(m, '^(000|666|9)') AND NOT regexp_matches(m, '-00-|-0000$')"),
        _span_sql("secret", SECRET_PATTERN, f"regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') AND {_ENTROPY} >= {SECRET_BITS}"),
    ])
    + r"""
), placed AS (
  SELECT *, a + len(m) AS b, t[greatest(a - 47, 1):a] AS l, t[a + len(m) + 1:a + len(m) + 48] AS r FROM found
), kept AS (
  SELECT doc_id, kind, a, b, list_position(['email', 'ip', 'card', 'phone', 'iban', 'ssn', 'secret'], kind) AS k FROM placed
  WHERE kind IN ('email', 'ip', 'card', 'phone')
    OR kind = 'iban' AND NOT regexp_matches(l, '[A-Za-z0-9]$') AND NOT regexp_matches(r, '^[A-Za-z0-9]')
      AND (NOT regexp_matches(lower(l || ' ' || r), 'sample') OR regexp_matches(lower(l || ' ' || r), 'iban|account|bank|konto|cuenta|compte') OR 0.8 - 0.3 >= 0.5)
    OR kind = 'ssn' AND NOT regexp_matches(l, '[0-9-]$') AND NOT regexp_matches(r, '^[0-9-]')
      AND regexp_matches(lower(l || ' ' || r), 'ssn|social|security') AND NOT regexp_matches(lower(l || ' ' || r), 'order|invoice|serial')
    OR kind = 'secret' AND NOT regexp_matches(l, '[A-Za-z0-9+/_-]$') AND NOT regexp_matches(r, '^[A-Za-z0-9+/_-]')
      AND regexp_matches(lower(l), 'LEAD') AND NOT regexp_matches(lower(l || ' ' || r), 'DOUBT')
), joined AS (
  SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
    count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY k, a) FILTER (k <= 4) AS base,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY k, a) AS spans, count(*) AS n_spans
  FROM kept GROUP BY 1
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_spans, 0) AS n_spans
FROM texts LEFT JOIN joined USING (doc_id)
"""
).replace("LEAD", SECRET_LEAD.replace("'", "''")).replace("DOUBT", SECRET_DOUBT)


@query("op1_toxicity")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op7_quality_classifier")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op6_language_id")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return identified(table(spark, folder, "documents"))


@query("op2_quotation_linking")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return linked_messages(table(spark, folder, "conversations"))


@query("op11_centroid_clustering")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return clusters(table(spark, folder, "embeddings"))


def _clustering_sql(how: PivotClustering) -> str:
    distance = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    floor = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
    parts = [
        rf"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({how.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {how.components} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {how.components}
)""",
        rf"""c0 AS MATERIALIZED (
  SELECT k, v AS c FROM (SELECT row_number() OVER (ORDER BY sha256('{how.seed}:' || vec_id) NULLS LAST, v) - 1 AS k, v FROM kept) WHERE k < {how.clusters}
)""",
    ]
    for i in range(how.rounds + 1):
        parts.append(rf"""a{i} AS MATERIALIZED (
  SELECT r, min({{'d': {distance}, 'k': k}}) AS best FROM kept, c{i} GROUP BY r
)""")
        if i < how.rounds:
            parts.append(rf"""c{i + 1} AS MATERIALIZED (
  SELECT k, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
    SELECT k, list({floor} ORDER BY i) AS m FROM (
      SELECT best.k AS k, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n
      FROM (SELECT best, unnest(v) AS x, unnest(range(1, {how.components + 1})) AS i FROM kept JOIN a{i} USING (r)) GROUP BY 1, 2
    ) GROUP BY k
  ) USING (k)
)""")
    return f"WITH {', '.join(parts)}" + rf"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
  CAST(sum(best.d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM kept JOIN a{how.rounds} USING (r) JOIN c{how.rounds} ON k = best.k
"""


ORACLES["op11_centroid_clustering"] = _clustering_sql(PivotClustering())


@query("op12_merkle_manifest")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return verified_documents(table(spark, folder, "documents"))


def _levels_sql(prefix: str, levels: int) -> str:
    """Levels of trees (tree, i, d) from ``{prefix}0``, runs of their nodes and one row of siblings per node."""
    parts = []
    for k in range(levels):
        parts.append(rf"""{prefix}r{k} AS MATERIALIZED (
  SELECT tree, i // {FAN} AS r, list(d ORDER BY i) AS ds, max(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {prefix}{k}) GROUP BY 1, 2
), {prefix}{k + 1} AS MATERIALIZED (
  SELECT tree, r AS i, CASE WHEN n = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS d FROM {prefix}r{k}
)""")
    return ", ".join(parts)


def _folds_sql(prefix: str, after: str, levels: int) -> str:
    """From ``{after}`` (row, tree, i, cur, proof) up all levels: the folded digest and the siblings so far."""
    parts, before = [], after
    for k in range(levels):
        parts.append(rf"""{prefix}f{k} AS MATERIALIZED (
  SELECT w.row, w.tree, w.i // {FAN} AS i,
    CASE WHEN n = 1 THEN cur ELSE sha256(array_to_string(ds[:w.i % {FAN}], '') || cur || array_to_string(ds[w.i % {FAN} + 2:], '')) END AS cur,
    proof || CASE WHEN n = 1 THEN '' ELSE array_to_string(ds[:w.i % {FAN}], '') || array_to_string(ds[w.i % {FAN} + 2:], '') END AS proof
  FROM {before} w JOIN {prefix}r{k} r ON r.tree = w.tree AND r.r = w.i // {FAN}
)""")
        before = f"{prefix}f{k}"
    return ", ".join(parts)


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _crc32_sql(text: str) -> str:
    """crc32 of a short ASCII string, bit by bit."""
    return (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))), "
        "lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, CAST(3988292384 AS BIGINT)) ELSE v // 2 END)), "
        "CAST(4294967295 AS BIGINT))"
    )


ORACLES["op12_merkle_manifest"] = rf"""
WITH hashed AS (
  SELECT doc_id, lang, {_leaf_sql("text")} AS leaf,
    CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0
      THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents
), base AS MATERIALIZED (
  SELECT *, row_number() OVER () AS row, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree
  FROM hashed
), n0 AS (SELECT tree, i, leaf AS d FROM base), {_levels_sql("n", 8)},
l0 AS (SELECT 0 AS tree, tree AS i, d FROM n8), {_levels_sql("l", 4)},
s AS (SELECT row, tree, i, coalesce(changed, leaf) AS cur, '' AS proof FROM base), {_folds_sql("n", "s", 8)},
u AS (SELECT row, 0 AS tree, tree AS i, cur, proof FROM nf7), {_folds_sql("l", "u", 4)}
SELECT doc_id, leaf, n8.d AS subroot, l4.d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = l4.d AS verified
FROM base JOIN lf3 USING (row) JOIN n8 ON n8.tree = base.tree, l4
"""


@query("op13_sampled_splitters")
def _(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _sharding_sql(how: Sharding) -> str:
    parts = f"range(1, {how.shards + 1})"
    return rf"""
WITH RECURSIVE crcs AS (
  SELECT list(v ORDER BY b) AS t FROM (SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, CAST(3988292384 AS BIGINT)) ELSE v // 2 END) AS v FROM range(256) AS r(b))
), bytes AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS x FROM documents
), rows AS MATERIALIZED (
  SELECT row, doc_id, CAST(len(x) // 2 + 1 AS BIGINT) AS size, CAST('0x' || substr(md5(text), 1, 15) AS BIGINT) AS h,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(x, '..'), lambda b: CAST('0x' || b AS BIGINT))),
      lambda r, b: xor(r // 256, t[xor(r, b) % 256 + 1])), CAST(4294967295 AS BIGINT)) AS text_crc32
  FROM bytes, crcs
), whole AS (SELECT sum(size) AS size FROM rows),
heavy AS MATERIALIZED (
  SELECT rows.*, row_number() OVER (ORDER BY rows.size DESC, h, doc_id NULLS FIRST) AS k FROM rows, whole WHERE rows.size * {how.heavy * how.shards} > whole.size
), dealt AS (
  SELECT CAST(0 AS BIGINT) AS k, list_transform({parts}, lambda i: CAST(0 AS BIGINT)) AS loads, list_transform({parts}, lambda i: CAST(0 AS BIGINT)) AS counts,
    CAST(0 AS BIGINT) AS p
  UNION ALL
  SELECT heavy.k, list_transform({parts}, lambda i: loads[i] + CASE WHEN i = q THEN size ELSE 0 END),
    list_transform({parts}, lambda i: counts[i] + CASE WHEN i = q THEN 1 ELSE 0 END), q
  FROM (SELECT *, list_position(loads, list_min(loads)) AS q FROM dealt) d JOIN heavy ON heavy.k = d.k + 1
), ends AS (SELECT loads, counts FROM dealt ORDER BY k DESC LIMIT 1),
light AS MATERIALIZED (SELECT rows.* FROM rows ANTI JOIN heavy USING (row)),
rest AS (SELECT coalesce(CAST(sum(size) AS BIGINT), 0) AS rest FROM light),
full_to AS (
  SELECT list_min(list_transform({parts}, lambda j: CAST(ceil((rest + list_sum(list_sort(loads)[:j])) / j) AS BIGINT))) AS level FROM ends, rest
), cuts AS (
  SELECT list_transform({parts}, lambda k: CAST(list_sum(list_transform(loads[:k], lambda x: greatest(0, level - x))) AS BIGINT)) AS cut FROM ends, full_to
), placed AS (
  SELECT *, CAST(len(list_filter(cut[:{how.shards - 1}], lambda c: 2 * c <= 2 * upto - size)) AS INTEGER) AS shard
  FROM (SELECT *, CAST(sum(size) OVER (ORDER BY h, doc_id NULLS FIRST, row) AS BIGINT) AS upto FROM light), cuts
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, CAST(counts[shard + 1] + row_number() OVER (PARTITION BY shard ORDER BY h, doc_id NULLS FIRST, row) - 1 AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM placed, ends
UNION ALL
SELECT doc_id, size, text_crc32, 'bytes', CAST(p - 1 AS INTEGER), counts[p] - 1, NULL FROM heavy JOIN dealt USING (k)
"""


ORACLES["op13_sampled_splitters"] = _sharding_sql(Sharding())
