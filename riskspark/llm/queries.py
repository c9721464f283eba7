"""The named queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.llm import (
    decontaminate,
    fingerprints,
    html_extract,
    language_id,
    license_scan,
    merkle,
    packing,
    pii,
    simhash,
    spelling,
    substring_dedup,
    tier_packing,
    toxicity,
)
from riskspark.llm.common import crc_mod, read_table


def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op2_tree_model_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op3_seed_extend_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(read_table(spark, sf_dir, "documents"))
    of_kind = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    return found.select(
        "doc_id",
        *[of_kind(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op5_segment_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(crc_mod("doc_id", 3) != 1))
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", "predicted", "passages")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.fingerprint_edits(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.digest(F.col("own")).alias("fingerprint"),
        fingerprints.digest(F.col("other")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op8_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, benchmark)


def op9_naive_bayes_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(crc_mod("doc_id", 4) != 2))
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return language_id.predict(docs, model).select("doc_id", held_out, "lang_pred", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = merkle.leaf_of(F.translate("text", ascii_uppercase, ascii_lowercase))
    other = F.when(crc_mod("doc_id", 5) == 0, lowered)
    rows = merkle.manifest(read_table(spark, sf_dir, "documents"), tampered=other)
    return merkle.verify(rows, F.coalesce("tampered", "leaf")).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified"
    )


def op13_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tier_packing.pack(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sum_of_squares_packing": op1_sum_of_squares_packing,
    "op2_tree_model_html": op2_tree_model_html,
    "op3_seed_extend_dedup": op3_seed_extend_dedup,
    "op4_crf_pii": op4_crf_pii,
    "op5_segment_toxicity": op5_segment_toxicity,
    "op6_license_scan": op6_license_scan,
    "op7_winnowing": op7_winnowing,
    "op8_spaced_seed_decontamination": op8_spaced_seed_decontamination,
    "op9_naive_bayes_language": op9_naive_bayes_language,
    "op10_simhash": op10_simhash,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_tier_packing": op13_tier_packing,
}

#: CRC-32 of a byte list ``b`` from a state, by its table of 256 entries made from the polynomial.
_CRC_TABLE = """crc_table AS (
    SELECT list(list_reduce(range(1, 9), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, v) ORDER BY v) AS t
    FROM (SELECT unnest(range(0, 256)) AS v)
)"""
_CRC = """xor(4294967295, list_reduce([instr('0123456789ABCDEF', hex({text})[2 * k - 1]) * 16 + instr('0123456789ABCDEF', hex({text})[2 * k]) - 17
    FOR k IN range(1, strlen({text}) + 1)], lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8), 4294967295))"""

def _merkle_sql(levels: int = 6) -> str:
    """The manifest by unrolled levels of both trees; 16 ** 6 rows of a source are more than SQL is run on."""

    def coded(text: str) -> str:
        values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    def tree(name: str, key: str) -> str:
        """From ``name``0 (key, depth, rank, digest): all levels, and the siblings of each node."""
        parts = []
        for level in range(1, levels + 1):
            below = f"{name}{level - 1}"
            frame = f"PARTITION BY {key}, rank // 16 ORDER BY rank ROWS BETWEEN"
            parts.append(
                f"""{name}{level} AS (SELECT {key}, depth, rank // 16 AS rank,
    CASE WHEN depth >= {level} THEN sha256(string_agg(digest, '' ORDER BY rank)) ELSE min(digest) END AS digest
    FROM {below} GROUP BY {key}, depth, rank // 16)"""
            )
            parts.append(
                f"""{name}_steps{level} AS (SELECT {key}, rank, depth >= {level} AS is_step,
    coalesce(string_agg(digest, '') OVER ({frame} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
    coalesce(string_agg(digest, '') OVER ({frame} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {below})"""
            )
        return ", ".join(parts)

    def depth(count: str) -> str:
        return "CASE " + " ".join(f"WHEN {count} <= {16**level} THEN {level}" for level in range(levels + 1)) + " END"

    def climb(before: str, name: str, key: str, rank: str) -> str:
        """The proof and the folded digest of every row after all levels of a tree."""
        parts = []
        for level in range(1, levels + 1):
            parts.append(
                f"""{name}_up{level} AS (SELECT u.* REPLACE (CASE WHEN is_step THEN proof || b || a ELSE proof END AS proof,
    CASE WHEN is_step THEN sha256(b || folded || a) ELSE folded END AS folded)
    FROM {before} u JOIN {name}_steps{level} s ON u.{key} IS NOT DISTINCT FROM s.{key} AND u.{rank} // {16 ** (level - 1)} = s.rank)"""
            )
            before = f"{name}_up{level}"
        return ", ".join(parts)

    lowered = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"
    return f"""
WITH {_CRC_TABLE}, leaves AS (
    SELECT doc_id, source, {coded("text")} AS digest, CASE WHEN {_CRC.format(text="doc_id::VARCHAR")} % 5 = 0 THEN {coded(lowered)} END AS tampered
    FROM documents, crc_table
), doc0 AS (
    SELECT *, {depth("count(*) OVER (PARTITION BY source)")} AS depth,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS rank FROM leaves
), {tree("doc", "source")}, top0 AS (
    SELECT 0 AS one, source, digest, {depth("count(*) OVER ()")} AS depth, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS rank FROM doc{levels}
), {tree("top", "one")}, start AS (
    SELECT d.doc_id, d.source, d.digest AS leaf, d.rank, t.rank AS top_rank, 0 AS one, t.digest AS subroot, r.digest AS root, '' AS proof, coalesce(tampered, d.digest) AS folded
    FROM doc0 d JOIN top0 t ON d.source IS NOT DISTINCT FROM t.source, top{levels} r
), {climb("start", "doc", "source", "rank")}, {climb(f"doc_up{levels}", "top", "one", "top_rank")}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM top_up{levels}
"""


ORACLE_SQL: dict[str, str] = {
    "op3_seed_extend_dedup": r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, list_slice(w, i, i + 49) AS seq
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)
), firsts AS (
    SELECT seq, min(doc_id) AS first_doc FROM windows GROUP BY seq
), cut AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j
    FROM windows JOIN firsts USING (seq) WHERE first_doc < doc_id
), cuts AS (
    SELECT doc_id, list(j) AS js FROM cut GROUP BY doc_id
), kept AS (
    SELECT doc_id, len(w) AS n, [w[k] FOR k IN range(1, len(w) + 1) IF js IS NULL OR NOT list_contains(js, k)] AS k
    FROM words LEFT JOIN cuts USING (doc_id)
)
SELECT doc_id, n AS n_words, n - len(k) AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
""",
    "op11_spelling_variants": f"""
WITH RECURSIVE {_CRC_TABLE}, runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL
), checked AS (
    SELECT run, n, {_CRC.format(text="(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM counted, crc_table
), words AS (
    SELECT word, sum(n)::BIGINT AS n
    FROM (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM checked)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cuts AS (
    SELECT word, k, left(word, k - 1) || substr(word, k + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS k FROM words)
), near AS (
    SELECT a.word, b.word AS near FROM cuts a JOIN cuts b USING (k, rest) WHERE a.word <> b.word AND length(a.word) = length(b.word)
    UNION SELECT c.word, w.word FROM cuts c JOIN words w ON c.rest = w.word
    UNION SELECT w.word, c.word FROM cuts c JOIN words w ON c.rest = w.word
), best AS (
    SELECT near.word, count(*) AS n_near, min((-o.n, near.near)) AS top FROM near JOIN words o ON o.word = near.near GROUP BY near.word
), forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top[1] >= 10 * n THEN top[2] END AS form, CASE WHEN -top[1] >= 10 * n THEN -top[1] END AS form_n
    FROM words LEFT JOIN best USING (word)
), ways AS (
    SELECT word, form, word AS at FROM forms
    UNION ALL SELECT ways.word, forms.form, forms.word FROM ways JOIN forms ON ways.form = forms.word
)
SELECT word, forms.form, ways.at AS root, n, n_near, form_n FROM forms JOIN ways USING (word) WHERE ways.form IS NULL
""",
    "op12_merkle_manifest": _merkle_sql(),
}
