"""The registered queries of the text operators and the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import (
    collocations,
    decontam,
    jaccard,
    lattice,
    merkle,
    mixing,
    packing,
    pii,
    secrets,
    simhash,
    suffixes,
    toxicity,
    urls,
)
from stationflow.llm.shared import UPPER, span_list

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


@query(
    r"""
    WITH thin AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
               CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 12) AS BIGINT) AS h
        FROM documents),
    sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM thin GROUP BY source),
    weighed AS (
        SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS w
        FROM sizes),
    -- After the k sources of the lowest cap by weight are full, the rest share what is left.
    filled AS (
        SELECT *, sum(2.0::DOUBLE * s) OVER o - 2.0::DOUBLE * s AS full_before, sum(w) OVER () - sum(w) OVER o + w AS open_weight,
               1.5::DOUBLE * sum(s) OVER () AS total
        FROM weighed WINDOW o AS (ORDER BY 2.0::DOUBLE * s / w, source NULLS LAST)),
    water AS (
        SELECT (total - full_before) / open_weight AS level FROM filled
        WHERE 2.0::DOUBLE * s >= (total - full_before) / open_weight * w
        ORDER BY full_before, 2.0::DOUBLE * s / w LIMIT 1),
    targets AS (
        SELECT source, s, CASE WHEN 2.0::DOUBLE * s < level * w THEN 2.0::DOUBLE * s ELSE level * w END AS target
        FROM weighed, water),
    budgets AS (
        SELECT *, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS whole FROM targets),
    steps AS (
        SELECT t.source, h, sum(size) AS words FROM thin t GROUP BY t.source, h),
    summed AS (
        SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM steps),
    edges AS (
        SELECT b.source, min(h) AS edge, arg_min(upto, h) AS upto, arg_min(words, h) AS words, any_value(target - whole * s) AS budget
        FROM summed x JOIN budgets b ON x.source IS NOT DISTINCT FROM b.source
        WHERE target - whole * s > 0 AND upto >= target - whole * s GROUP BY b.source)
    SELECT doc_id, size, s AS source_size, target,
           CAST(size * (whole + CASE WHEN h < edge OR (h = edge AND upto - budget < budget - (upto - words)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM thin t JOIN budgets b ON t.source IS NOT DISTINCT FROM b.source
    LEFT JOIN edges e ON t.source IS NOT DISTINCT FROM e.source
    """
)
def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Words that each document gives to a mix of half as many words again."""
    return mixing.mix(table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query(
    r"""
    WITH words AS (
        SELECT doc_id, row_number() OVER () AS r,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    items AS (
        SELECT item_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, array_to_string(w[i + 1:i + 10], ' ') AS phrase, least(len(w), 10) AS n
        FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS i FROM items WHERE len(w) > 0)),
    lengths AS (SELECT DISTINCT n FROM windows),
    grams AS (
        SELECT r, i, n, array_to_string(w[i + 1:i + n], ' ') AS phrase
        FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS i FROM words, lengths WHERE len(w) >= n)),
    hits AS (SELECT r, i, g.n, item_id FROM grams g JOIN windows x ON g.phrase = x.phrase AND g.n = x.n),
    covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
    named AS (
        SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM words LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
    """
)
def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Words of each document inside a ten-word window of a benchmark item."""
    found = decontam.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op6_decontamination_near(spark: SparkSession, sf: str) -> DataFrame:
    """Ten-word windows of each document's benchmark items that match it by proximity only."""
    found = decontam.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_hit",
        "n_near",
        F.size("near_items").cast("long").alias("n_near_items"),
        F.array_join("near_items", ",").alias("near_items"),
    )


_CERTAIN = [k for k, v in secrets.KINDS.items() if v[4]]


@query()
def op7_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets of each document, and weak parts of credentials that occur together."""
    found = secrets.scan(table(spark, sf, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    certain = F.filter("spans", lambda s: s["sure"])
    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{k}") for k in _CERTAIN],
        F.sha2(span_list(certain), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


# The rules of the URL query: fixed values.
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


@query(
    r"""
    WITH RECURSIVE named AS (
        SELECT page_id, url, html,
               translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
               regexp_replace(url, '#.*$', '', 's') AS node
        FROM pages),
    tags AS (
        SELECT node AS u, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\b[^>]*>')) AS tag FROM named),
    edges AS (
        SELECT DISTINCT u, v FROM (
            SELECT u, regexp_extract(tag, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS v FROM tags WHERE regexp_matches(tag, '(?i)canonical')
            UNION ALL
            SELECT u, regexp_extract(tag, '(?i)\burl\s*=\s*["'']?([^"''\s>;]+)', 1) FROM tags WHERE regexp_matches(tag, '(?i)http-equiv.*refresh'))
        WHERE v <> ''),
    sides AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
    reach AS (SELECT u, u AS v FROM sides UNION SELECT r.u, s.v FROM reach r JOIN sides s ON r.v = s.u),
    places AS (
        SELECT u, translate(regexp_extract(v, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(v, '://[^/?#]*([^?#]*)', 1) AS path FROM reach),
    rules(rule, rule_host, rule_path, verdict) AS (VALUES
        ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
        ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
        ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
    ruled AS (
        SELECT host, path, arg_max(rule, len(rule)) AS rule, arg_max(verdict, len(rule)) AS verdict
        FROM (SELECT DISTINCT host, path FROM (SELECT host, path FROM named UNION SELECT host, path FROM places)) p
        JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY host, path),
    classes AS (SELECT u AS node, min(verdict) AS verdict FROM places LEFT JOIN ruled USING (host, path) GROUP BY u)
    SELECT page_id, host, path, rule, coalesce(r.verdict, c.verdict, 'allow') AS verdict,
           (SELECT min(v) FROM reach x WHERE x.u = n.node) AS alias_of
    FROM named n LEFT JOIN ruled r USING (host, path) LEFT JOIN classes c USING (node)
    """
)
def op1_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict on every page by rules and redirect classes."""
    return urls.judge(table(spark, sf, "pages"), urls.rule_table(spark, URL_RULES))


@query()
def op9_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint of each document and of its edited text, and rows near every hundredth one."""
    found = simhash.fingerprints(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        simhash.hexed(F.col("f")).alias("fingerprint"),
        simhash.hexed(F.col("edited_f")).alias("edited_fingerprint"),
        simhash.likeness(F.col("f"), F.col("edited_f")).alias("near_edited"),
        simhash.likeness(F.col("f"), F.col("next_f")).alias("near_next"),
        "n_near",
    )


@query()
def op9_fingerprints_near(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints near those of every hundredth row; ``op9_fingerprints`` has the rows of each."""
    links, _ = simhash.near_prints(table(spark, sf, "documents"))
    return links.select(
        simhash.hexed(F.col("f")).alias("fingerprint"),
        simhash.hexed(F.col("found")).alias("near_fingerprint"),
        "differ",
        "copies",
    )


@query()
def op3_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data of each document."""
    found = pii.scan(table(spark, sf, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("pii")).alias("spans"),
    )


def held_out(parts: int) -> Column:
    """Whether the remainder of the id's checksum is 1; a NULL id is not held out."""
    rest = F.crc32(F.col("doc_id").cast("string")) % parts
    return F.coalesce(rest == 1, F.lit(False))


@query()
def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of each document, learnt from labelled documents that are not held out."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    weights = toxicity.train(docs, table(spark, sf, "labels"), ~held_out(3))
    scored = toxicity.score(docs, weights)
    return scored.select(
        "doc_id",
        held_out(3).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query()
def op10_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of documents whose sets of four-word shingles are similar by 85 per cent."""
    found = jaccard.classes(table(spark, sf, "documents"), n=4, percent=85)
    return found.select("doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id")


@query()
def op2_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What stays of each document without strings of 200 bytes that start elsewhere too."""
    found = suffixes.without_repeats(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query()
def op4_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Log10 probability of each document by words, and by all segmentations into pieces."""
    held = held_out(5)
    found = lattice.score(table(spark, sf, "documents"), ~held)
    return found.select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


_PART = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_PART.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_LOWER = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
# Nodes of all trees of a table (tree, idx, h, n), level by level.
_NODES = """
        SELECT tree, 0 AS level, idx, h, n FROM {leaves}
        UNION ALL
        SELECT tree, level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (n + 7) // 8
        FROM {nodes} WHERE n > 1 GROUP BY tree, level, n, idx // 8"""
_SIDES = """
        SELECT *, coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
               coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
        FROM {nodes} WINDOW run AS (PARTITION BY tree, level, idx // 8 ORDER BY idx)"""


@query(
    f"""
    WITH RECURSIVE bits AS (
        SELECT i, i AS c, 0 AS k FROM range(256) t(i)
        UNION ALL
        SELECT i, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM bits WHERE k < 8),
    steps AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
    hashed AS (
        SELECT doc_id, coalesce('1' || lang, '0') AS tree, {_LEAF.format(text="text")} AS leaf,
               CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT for x in string_split(CAST(doc_id AS VARCHAR), '')]),
                             lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INT) + 1])), 4294967295) % 3 = 0
                    THEN {_LEAF.format(text=_LOWER)} ELSE {_LEAF.format(text="text")} END AS claimed
        FROM documents, steps),
    leaves AS (
        SELECT *, leaf AS h, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS idx,
               count(*) OVER (PARTITION BY tree) AS n
        FROM hashed),
    nodes AS ({_NODES.format(leaves="leaves", nodes="nodes")}),
    sides AS ({_SIDES.format(nodes="nodes")}),
    tops AS (
        SELECT '' AS tree, tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n
        FROM nodes WHERE n = 1),
    upper_nodes AS ({_NODES.format(leaves="tops", nodes="upper_nodes")}),
    upper_sides AS ({_SIDES.format(nodes="upper_nodes")}),
    walk AS (
        SELECT tree, idx AS leaf_idx, 0 AS level, idx, claimed AS cur, '' AS proof FROM leaves
        UNION ALL
        SELECT w.tree, leaf_idx, w.level + 1, w.idx // 8, sha256(lefts || cur || rights), proof || lefts || rights
        FROM walk w JOIN sides s ON s.tree = w.tree AND s.level = w.level AND s.idx = w.idx WHERE s.n > 1),
    climbed AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY tree, leaf_idx ORDER BY level DESC) = 1),
    upper_walk AS (
        SELECT c.tree AS name, leaf_idx, 0 AS level, t.idx, cur, proof, t.h AS subroot FROM climbed c JOIN tops t ON t.name = c.tree
        UNION ALL
        SELECT name, leaf_idx, w.level + 1, w.idx // 8, sha256(lefts || cur || rights), proof || lefts || rights, subroot
        FROM upper_walk w JOIN upper_sides s ON s.level = w.level AND s.idx = w.idx WHERE s.n > 1),
    ends AS (SELECT * FROM upper_walk QUALIFY row_number() OVER (PARTITION BY name, leaf_idx ORDER BY level DESC) = 1)
    SELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = u.h AS verified
    FROM leaves l JOIN ends e ON e.name = l.tree AND e.leaf_idx = l.idx, (SELECT h FROM upper_nodes WHERE n = 1) u
    """
)
def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Place of each document in the dataset's Merkle tree; a third are claimed with a changed text."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(tampered, F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = merkle.leaf_rows(table(spark, sf, "documents"), fields, claimed={"text": text})
    return merkle.prove(merkle.build(rows))


@query()
def op13_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of all documents packed into sequences of 2048."""
    import public_tokenizers

    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    return packing.pack(packing.pieces(table(spark, sf, "documents"), *files))


@query(
    f"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents),
    worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
    grams AS (
        SELECT lang, k AS words, array_to_string(w[i + 1:i + k], ' ') AS phrase
        FROM (SELECT lang, w, k, unnest(range(len(w) - k + 1)) AS i FROM worded, range(1, 4) t(k) WHERE len(w) >= k)),
    counts AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL),
    totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE words = 1 GROUP BY lang),
    candidates AS (SELECT * FROM counts WHERE words > 1 AND f >= 10),
    cuts AS (
        SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
               array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
        FROM candidates, range(1, 3) t(k) WHERE k < words),
    frequent AS MATERIALIZED (SELECT lang, phrase, f FROM counts WHERE f >= 10),
    scored AS (
        SELECT c.lang, c.phrase, a, l.f AS l, r.f AS r,
               CAST(CAST(a AS HUGEINT) * a * 1000000 // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
        FROM cuts c
        JOIN frequent l ON l.lang = c.lang AND l.phrase = head
        JOIN frequent r ON r.lang = c.lang AND r.phrase = tail
        QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
    around AS (
        SELECT lang, phrase, max(f) AS longer FROM (
            SELECT lang, unnest([regexp_replace(phrase, ' [^ ]*$', ''), regexp_replace(phrase, '^[^ ]* ', '')]) AS phrase, f
            FROM candidates WHERE words = 3)
        GROUP BY ALL),
    kept AS (
        SELECT s.* FROM scored s LEFT JOIN around x ON x.lang = s.lang AND x.phrase = s.phrase
        WHERE longer IS NULL OR 100 * longer < 50 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
    """
)
def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """Phrases of two and three words that stand together, by language."""
    return collocations.collocations(table(spark, sf, "documents"))
