"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.collocations import collocations
from ledgerloom.llm.common import read
from ledgerloom.llm.decontamination import contaminated
from ledgerloom.llm.language import language_id
from ledgerloom.llm.licenses import license_scan
from ledgerloom.llm.minhash import near_duplicates
from ledgerloom.llm.neighbours import nearest
from ledgerloom.llm.packing import pack
from ledgerloom.llm.periodic import periodic_runs
from ledgerloom.llm.pieces import encoded
from ledgerloom.llm.token_counts import token_counts
from ledgerloom.llm.token_files import token_files
from ledgerloom.llm.toxicity import toxicity
from ledgerloom.llm.url_templates import url_filter


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(read(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(read(spark, sf_dir, "documents"))


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(read(spark, sf_dir, "documents"), with_ids=False)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(read(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents")).drop("detections")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))


def with_planted_repeats(documents: DataFrame) -> DataFrame:
    """``doc_id, text``; the last words of every tenth text by the hash of its id repeat some words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text").cast("string"), r"[ \x09-\x0D]+"), lambda w: w != "")
    rows = documents.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    at = "(g % size(words))"
    period = f"(1 + (size(words) - {at}) div (3 + g % 8))"
    place = f"CASE WHEN i < {at} THEN i ELSE {at} + (i - {at}) % {period} END"
    repeated = f"concat_ws(' ', transform(sequence(0, size(words) - 1), i -> get(words, CAST({place} AS int))))"
    return rows.select("doc_id", F.expr(f"CASE WHEN size(words) > 0 THEN {repeated} ELSE text END").alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_repeats(read(spark, sf_dir, "documents")))
    most = """aggregate(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>), (best, r) ->
        CASE WHEN best IS NULL OR r.length * best.period > best.length * r.period THEN r ELSE best END)"""
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return found.withColumn("best", F.expr(most)).selectExpr(
        "doc_id",
        "CAST(size(runs) AS bigint) AS n_runs",
        "best.start AS start",
        "best.length AS length",
        "best.period AS period",
        "1000 * best.length div best.period AS exponent_milli",
        f"sha2({lines}, 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filters,
        op2_token_counts,
        op3_decontamination,
        op4_nearest_neighbours,
        op5_near_duplicates,
        op6_token_files,
        op7_sentence_pieces,
        op8_language_id,
        op9_license_scan,
        op10_toxicity,
        op11_best_fit_packing,
        op12_periodic_runs,
        op13_phrase_collocations,
    )
}
#: The other methods are none that DuckDB's SQL can repeat; tests/llm compares them with brute force.
ORACLES: dict[str, str] = {
    "op13_phrase_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), sizes AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang
), places AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split
), counts AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM places, range(1, 5) AS r(k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1
), cuts AS (
    SELECT lang, k, phrase, a, cut, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:k], ' ') AS rest
    FROM candidates, range(1, 4) AS c(cut) WHERE cut < k
), scored AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, (2000000 * c.a::HUGEINT // (x.f + y.f))::BIGINT AS score, cut
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1
), inner_phrases AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
    FROM candidates, range(2, 4) AS t(m), range(1, 4) AS s(i) WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), kept AS (
    SELECT s.* FROM scored s LEFT JOIN inner_phrases p ON p.lang = s.lang AND p.phrase = s.phrase
    WHERE p.longer IS NULL OR 100 * p.longer::HUGEINT < 80 * s.a::HUGEINT
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, r.score
FROM ranked r JOIN sizes n ON n.lang = r.lang WHERE r.rank <= 2000
""",
}
