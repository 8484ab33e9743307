"""The registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplecraft import prepare
from samplecraft.llm import decontaminate, fill_middle, html_text, jaccard, mix, nearest, periods, quality, secrets, simhash, suffixes, token_files, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("hit_items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, quality.training_labels(table(spark, sf_dir, "labels")))
    scored = quality.score(docs, model)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = mix.assign(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    first = F.when(F.size("positions") > 0, F.col("positions")[0])
    return assigned.select("doc_id", "size", "source_size", "target", "taken", first.alias("first_position")).repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


@query
def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_documents(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


@query
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.to_arc(table(spark, sf_dir, "pages"))
    return warc.read_warc(warc.convert(archives)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id")


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(rows: F.Column) -> F.Column:
        return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> F.Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["base"])
    counts = [count(k) for k in secrets.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


@query
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.train(pages)).select("page_id", "url", "text", "n_chars")


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """The words of each text joined by one blank; in one document of ten they repeat from a word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    docs = docs.select("doc_id", words.alias("w"), h.alias("h"), F.floor(h / 10).alias("g"), F.size(words).alias("n"))
    start = (F.col("g") % F.col("n")).cast("int")
    period = (F.lit(1) + F.floor((F.col("n") - start) / (3 + F.col("g") % 8))).cast("int")
    left = F.col("n") - start
    cycle = F.flatten(F.array_repeat(F.slice("w", start + 1, period), F.ceil(left / period).cast("int")))
    made = F.concat(F.slice("w", F.lit(1), start), F.slice(cycle, F.lit(1), left))
    repeated = F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), made).otherwise(F.col("w"))
    return docs.select("doc_id", F.array_join(repeated, " ").alias("text"))


@query
def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.find(with_planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    found = found.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_middle.restored(), 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLES["op13_fill_middle"] = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents
), cut AS (
    SELECT *, ('0x' || substr(d, 1, 8))::BIGINT % (n + 1) AS x, ('0x' || substr(d, 9, 8))::BIGINT % (n + 1) AS y,
        t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(d, 17, 8))::BIGINT % 100 >= 90 AS plain,
        ('0x' || substr(d, 25, 8))::BIGINT % 100 < 20 AS spm
    FROM drawn
), parts AS (
    SELECT *, least(x, y) AS a, greatest(x, y) AS b, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM cut
)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
    CASE WHEN NOT plain THEN a END AS prefix_chars, CASE WHEN NOT plain THEN b - a END AS middle_chars,
    sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
"""

ORACLES["op1_decontaminate"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, least(13, len(w)) AS size FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS words FROM b, unnest(range(1, len(w) - size + 2)) AS u(i) WHERE size > 0
), places AS (
    SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS words FROM d, (SELECT DISTINCT size FROM windows) AS sizes, unnest(range(1, len(w) - size + 2)) AS u(i)
), found AS (
    SELECT r, i, size, item_id FROM places JOIN windows USING (size, words)
), hit AS (
    SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT r, i, size FROM found), unnest(range(size)) AS u(k) GROUP BY r
), items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

#: The identifier is a name-based UUID of version 5 in the namespace of addresses, over key, address, date and digest.
ORACLES["op9_warc"] = r"""
WITH p AS (
    SELECT page_id, coalesce(nullif(url, ''), '-') AS address, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT payload_digest, min(page_id) AS keeper FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
), named AS (
    SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(concat(coalesce(page_id::VARCHAR, 'None'), ' ', address, ' 20240101000000 ', payload_digest))) AS h FROM p LEFT JOIN firsts USING (payload_digest)
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest, CASE WHEN keeper IS NULL OR page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id != keeper THEN keeper END AS refers_to,
    '<urn:uuid:' || concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), '5' || substr(h, 14, 3), substr('89ab', (('0x' || substr(h, 17, 1))::INTEGER % 4) + 1, 1) || substr(h, 18, 3), substr(h, 21, 12)) || '>' AS record_id
FROM named
"""
