"""The registered queries of the text operators, and SQL for those that SQL expresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import (
    centroids, exact, leaks, lm, near, packing, pieces, repeats, resample, secrets, tokens, toxic, urls,
)
from millrace.llm.common import read, texts
from millrace.session import prepare

QUERIES = {}
ORACLES = {}


def query(function):
    """Register a query under its name."""

    def run(spark, sf_dir) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_near_dedup(spark, sf_dir):
    return near.near_classes(read(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "class_size", "kept"
    )


@query
def op2_url_filter(spark, sf_dir):
    judged = urls.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")


@query
def op3_lm_scores(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return lm.score_texts(read(spark, sf_dir, "documents"), held_out)


@query
def op4_pieces(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.with_pieces(texts(read(spark, sf_dir, "documents")), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


@query
def op5_toxicity(spark, sf_dir):
    docs = texts(read(spark, sf_dir, "documents"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = read(spark, sf_dir, "labels").where(~held_out).select(
        "doc_id", F.col("toxic").alias("label")
    )
    score = toxic.fit_toxic(docs, labels).probability(F.col("text"))
    scored = docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxic.THRESHOLD).cast("int"))


@query
def op6_secret_scan(spark, sf_dir):
    scanned = secrets.scan_secrets(texts(read(spark, sf_dir, "documents")))
    base = F.filter("secrets", lambda s: s["kind"] < len(secrets.KINDS))

    def number(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return scanned.select(
        "doc_id",
        *[number(i).alias(f"n_{kind}") for i, (kind, *_) in enumerate(secrets.KINDS)],
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(F.col("secrets")).alias("spans"),
    )


@query
def op7_decontamination(spark, sf_dir):
    docs = texts(read(spark, sf_dir, "documents"))
    found = leaks.with_leaks(docs, read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("leaks.items") > 0).alias("leaked"),
        F.col("leaks.items").alias("item_ids"), F.col("leaks.distances").alias("distances"),
    )


@query
def op9_token_counts(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokens.token_counts(read(spark, sf_dir, "documents"), path)


@query
def op8_exact_dedup(spark, sf_dir):
    return exact.exact_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query
def op10_repeats(spark, sf_dir):
    return repeats.cut_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op11_importance_resample(spark, sf_dir):
    return resample.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op12_packing(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(read(spark, sf_dir, "documents"), path)


@query
def op13_clustering(spark, sf_dir):
    return centroids.cluster(read(spark, sf_dir, "embeddings"))


@query
def url_rules(spark, sf_dir):
    """What the rules alone say of each URL, which SQL can say too."""
    parsed = urls.with_host_and_path(read(spark, sf_dir, "pages").select("page_id", "url"))
    return parsed.select("page_id", "host", "path", urls.rule_of().alias("rule"))


@query
def secret_patterns(spark, sf_dir):
    """What the fixed patterns alone find, which SQL can find too."""
    return op6_secret_scan(spark, sf_dir).drop("spans")


ORACLES["op8_exact_dedup"] = """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _clustering_sql(rounds=centroids.ROUNDS, k=centroids.CLUSTERS, dimensions=centroids.DIMENSIONS):
    """All rounds spelt out, one after the other."""
    steps = [f"""kept AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
        FROM embeddings
        WHERE len(embedding) = {dimensions}
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions}
    ), place0 AS MATERIALIZED (
        SELECT CAST(row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id)) - 1 AS INTEGER) AS cluster, ints
        FROM kept QUALIFY cluster < {k}
    )"""]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
        SELECT vec_id, any_value(v.ints) AS ints, min({{'distance': list_sum(list_transform(
            list_zip(v.ints, p.ints), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'cluster': cluster}}) AS best
        FROM kept v CROSS JOIN place{r} p GROUP BY vec_id
    )""")
        if r < rounds:
            steps.append(f"""place{r + 1} AS MATERIALIZED (
        SELECT p.cluster, coalesce(m.ints, p.ints) AS ints FROM place{r} p LEFT JOIN (
            SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS ints FROM (
                SELECT best.cluster AS cluster, d, sum(ints[d]) AS s, count(*) AS n
                FROM near{r}, range(1, {dimensions + 1}) ds(d) GROUP BY ALL
            ) GROUP BY cluster
        ) m USING (cluster)
    )""")
    return "WITH " + ", ".join(steps) + f"""
        SELECT vec_id, CAST(best.cluster AS INTEGER) AS cluster, CAST(best.distance AS BIGINT) AS distance,
               CAST(sum(best.distance) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(best.distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(p.ints, ',')) AS centroid_sha256
        FROM near{rounds} JOIN place{rounds} p ON p.cluster = best.cluster
    """


ORACLES["op13_clustering"] = _clustering_sql()

_FITS = " ".join(
    f"WHEN (host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '/{rest}') THEN '{d}/{rest}'"
    for d, _, rest in sorted((rule.partition("/") for _, rule in urls.RULES), key=lambda r: -len("".join(r)))
)
ORACLES["url_rules"] = f"""
    WITH cut AS (
        SELECT page_id, position('://' IN coalesce(url, '')) AS mark, coalesce(url, '') AS url FROM pages
    ), tails AS (
        SELECT page_id, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS tail FROM cut
    ), hosts AS (
        SELECT page_id, regexp_extract(tail, '^[^/?#]*') AS raw, tail FROM tails
    ), parts AS (
        SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(substr(tail, length(raw) + 1), '^[^?#]*') AS path FROM hosts
    )
    SELECT page_id, host, path, CASE {_FITS} END AS rule FROM parts
"""

_VALUE = """(password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
ORACLES["secret_patterns"] = f"""
    WITH found AS (
        SELECT doc_id, k, kind, string_split_regex(t, p) AS gaps, regexp_extract_all(t, p) AS hits,
               regexp_extract_all(t, p, g) AS parts, least_length
        FROM (SELECT row_number() OVER () AS doc_row, doc_id, coalesce(text, '') AS t FROM documents),
             (VALUES (0, 'assign', '(?i){_VALUE}', 2, 6), (1, 'access', 'AKIA[A-Z0-9]+', 0, 20),
                     (2, 'hex', '[0-9a-f]+', 0, 24)) kinds(k, kind, p, g, least_length)
    ), ends AS (
        SELECT *, list_transform(range(1, len(hits) + 1), lambda i: length(gaps[i])) AS before,
               list_transform(hits, lambda h: length(h)) AS sizes FROM found
    ), spans AS (
        SELECT doc_id, list(struct_pack(a := start_, k := k, t := kind || ':' || start_ || ':' || (start_ + size))
                            ORDER BY start_, k) FILTER (good) AS all_of,
               count(*) FILTER (good AND k = 0) AS n_assign, count(*) FILTER (good AND k = 1) AS n_access,
               count(*) FILTER (good AND k = 2) AS n_hex
        FROM (
            SELECT doc_id, k, kind, size, length(part) >= least_length AS good,
                   CAST(sum(gap + size) OVER (PARTITION BY doc_id, k ORDER BY i) - size AS BIGINT) AS start_
            FROM (SELECT doc_id, k, kind, least_length, unnest(before) AS gap, unnest(sizes) AS size,
                         unnest(parts) AS part, unnest(range(1, len(hits) + 1)) AS i FROM ends)
        ) GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
           coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(array_to_string(list_transform(all_of, lambda s: s.t), ','), '')) AS base_sha256
    FROM documents d LEFT JOIN spans s ON s.doc_id = d.doc_id
"""

# Texts as hexadecimal digits: two a byte.
ORACLES["op10_repeats"] = f"""
    WITH docs AS MATERIALIZED (
        SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
    ), parts AS MATERIALIZED (
        SELECT r, c, substr(h, CAST(2 * c + 1 AS BIGINT), {2 * (500 + repeats.LENGTH - 1)}) AS part
        FROM (SELECT r, h, unnest(range(0, length(h) // 2 - {repeats.LENGTH - 1}, 500)) AS c FROM docs)
    ), strings AS (
        SELECT r, c + p AS p, md5(substr(part, CAST(2 * p + 1 AS BIGINT), {2 * repeats.LENGTH})) AS w
        FROM (SELECT r, c, part, unnest(range(0, length(part) // 2 - {repeats.LENGTH - 1})) AS p FROM parts)
    ), again AS (
        SELECT r, p FROM strings QUALIFY count(*) OVER (PARTITION BY w) > 1
    ), runs AS (
        SELECT r, p, sum(opens) OVER (PARTITION BY r ORDER BY p) AS run FROM (
            SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= {repeats.LENGTH} THEN 0 ELSE 1 END
                   AS opens FROM again)
    ), cut AS (
        SELECT r, list(first_ ORDER BY first_) AS f, list(last_ ORDER BY first_) AS l FROM (
            SELECT r, min(p) AS first_, max(p) + {repeats.LENGTH} AS last_ FROM runs GROUP BY r, run
        ) GROUP BY r
    ), kept AS (
        SELECT doc_id, length(h) // 2 AS n, f, l, h, list_concat([0], coalesce(l, [])) AS a,
               list_concat(coalesce(f, []), [length(h) // 2]) AS b
        FROM docs LEFT JOIN cut USING (r)
    )
    SELECT doc_id, n AS n_bytes, coalesce(n - list_sum(list_transform(range(1, len(a) + 1), lambda i: b[i] - a[i])), 0)::BIGINT
               AS n_removed,
           len(a) - 1 AS n_spans,
           sha256(unhex(array_to_string(list_transform(range(1, len(a) + 1),
               lambda i: substr(h, CAST(2 * a[i] + 1 AS BIGINT), CAST(2 * (b[i] - a[i]) AS BIGINT))), ''))) AS kept_sha256
    FROM kept
"""
