"""Registered queries of the operators, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bisector, decontamination, digest, merkle, mixing, packing, quality, repeats, secret_scan, simhash, token_counts, token_files, toxicity
from tidemark.session import scratch_path, ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; every machine has it under the same path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(ship_package(spark), sf_dir)

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return run


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), F.size("removed").alias("n_ranges")
    )


#: Words, every window of 35, windows that occur again, and the words they cover.
ORACLES["op1_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), starts AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 34], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)
), again AS (
  SELECT g FROM starts GROUP BY g HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM starts SEMI JOIN again USING (g)
), placed AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
), marked AS (
  SELECT p.doc_id, p.word, p.i, g.i IS NOT NULL AS out FROM placed p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.i = p.i
), kept AS (
  SELECT doc_id, count_if(out) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT out), '') AS kept,
         count_if(out AND NOT before) AS n_ranges
  FROM (SELECT *, coalesce(lag(out) OVER (PARTITION BY doc_id ORDER BY i), false) AS before FROM marked)
  GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, CAST(coalesce(n_ranges, 0) AS INTEGER) AS n_ranges
FROM d LEFT JOIN kept USING (doc_id)
"""


@query
def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.edited_likeness(table(spark, sf_dir, "documents"))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    spell = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    base = of(*secret_scan.KINDS)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secret_scan.KINDS]
    return found.select("doc_id", *counts, F.sha2(spell(base), 256).alias("base_sha256"), spell(F.col("spans")).alias("spans"))


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return token_files.token_digests(token_files.read_token_files(spark, path))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.words_taken(mixing.mix(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle.verified(merkle.manifest(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _merkle_sql(levels: int = 5) -> str:
    """The trees level by level, for sources of at most 16^levels rows and as many sources."""
    field = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(
        field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)
    ) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = (
        "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),"
        " lambda c: list_transform(range(8), lambda b: (ascii(c) >> b) & 1)))"
    )
    crc = f"xor(4294967295, list_reduce(list_concat([4294967295], {bits}), lambda c, b: xor(c >> 1, 3988292384 * xor(c & 1, b))))"

    def tree(nodes: str, x: str) -> list[str]:
        parts, last = [], nodes
        for k in range(levels):
            parts.append(
                f"{x}run{k} AS (SELECT g, i // 16 AS j, n, string_agg(h, '' ORDER BY i) AS run FROM {last} WHERE n > 1 GROUP BY ALL)"
            )
            parts.append(
                f"{x}{k + 1} AS (SELECT g, j AS i, (n + 15) // 16 AS n, sha256(run) AS h FROM {x}run{k}"
                f" UNION ALL SELECT g, i, n, h FROM {last} WHERE n = 1)"
            )
            last = f"{x}{k + 1}"
        return parts

    def walk(rows: str, x: str, group: str, place: str) -> list[str]:
        """Siblings and the folded node, level by level."""
        parts, last = [], rows
        for k in range(levels):
            at = f"64 * (({place} // {16**k}) % 16)"
            left, right = f"coalesce(substr(run, 1, {at}), '')", f"coalesce(substr(run, {at} + 65), '')"
            parts.append(
                f"{x}walk{k} AS (SELECT w.* REPLACE (proof || {left} || {right} AS proof,"
                f" CASE WHEN run IS NULL THEN fold ELSE sha256({left} || fold || {right}) END AS fold)"
                f" FROM {last} w LEFT JOIN {x}run{k} r ON r.g = w.{group} AND r.j = w.{place} // {16 ** (k + 1)})"
            )
            last = f"{x}walk{k}"
        return parts

    ctes = [
        f"d AS (SELECT doc_id, 'v' || source AS s, {leaf('text')} AS leaf,"
        f" CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS bad FROM documents)",
        "e AS (SELECT doc_id, coalesce(s, '') AS s, leaf, bad FROM d)",
        "p AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,"
        " count(*) OVER (PARTITION BY s) AS n FROM e)",
        "a0 AS (SELECT s AS g, i, n, leaf AS h FROM p)",
        *tree("a0", "a"),
        f"tops AS (SELECT g AS s, h AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS pos FROM a{levels})",
        "b0 AS (SELECT 1 AS g, pos AS i, count(*) OVER () AS n, subroot AS h FROM tops)",
        *tree("b0", "b"),
        "start AS (SELECT p.*, subroot, pos, 1 AS one, '' AS proof, bad AS fold FROM p JOIN tops USING (s))",
        *walk("start", "a", "s", "i"),
        *walk(f"awalk{levels - 1}", "b", "one", "pos"),
    ]
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256,"
        f" fold AS folded_root, fold = root.h AS verified FROM bwalk{levels - 1}, b{levels} AS root"
    )


ORACLES["op11_merkle_manifest"] = _merkle_sql()


@query
def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bisector.cluster(table(spark, sf_dir, "embeddings"), dims=64, k=16, rounds=3, scale=64)
    spelled = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(spelled, 256).alias("centroid_sha256")
    )


def _clusters_sql(k: int = 16, dims: int = 64, rounds: int = 3, scale: int = 64) -> str:
    """Every distance computed; floored means of whole numbers."""
    apart = f"CAST(list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i]))) AS BIGINT)"
    ctes = [
        f"v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v"
        f" FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims})",
        "c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM"
        f" (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, v FROM v ORDER BY h LIMIT {k}))",
    ]
    for r in range(rounds + 1):
        ctes.append(
            f"a{r} AS (SELECT vec_id, v, c, d FROM (SELECT v.vec_id, v.v, c.c, {apart} AS d FROM v, c{r} AS c)"
            " QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)"
        )
        if r < rounds:
            ctes.append(
                f"s{r} AS (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM"
                f" (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i)"
            )
            ctes.append(
                f"c{r + 1} AS (SELECT o.c, coalesce(m.v, o.v) AS v FROM c{r} o LEFT JOIN"
                f" (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{r} GROUP BY c) m USING (c))"
            )
    last = f"a{rounds}"
    return (
        "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, CAST({last}.c AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY {last}.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c.v, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256
FROM {last} JOIN c{rounds} AS c USING (c)"""
    )


ORACLES["op12_centroid_clusters"] = _clusters_sql()


@query
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), length=2048, end_id=1, digest=True)
