"""Queries about references' files, requests and writes about them, and their readers and writers on whole tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import text
from inkwell.operators import ml, references, taxonomy
from inkwell.operators.sums import matrix
from inkwell.plans.catalog import query
from inkwell.plans.models import vector_data
from inkwell.sources import models as stored_models
from inkwell.sources import papers, sinks
from inkwell.sources.storage import shared_folder
from inkwell.sources.tables import table

CLASSES = (references.MAIN_TEXT, "main", "tei", references.SUPPLEMENT_TEXT, "embedding")
EXTENSIONS = ("md", "pdf", "tei", "md", "parquet")
# A file's class (c), scope (m: everyone's, WB, null, FB and WB, FB), and the rest, for the SQL side.
FILES = """f AS (SELECT user_id AS curie, event_id AS file_id, event_id % 5 AS c, event_id // 5 % 5 AS m, event_id // 25 % 2 = 0 AS final, event_id // 5 % 2 = 0 AS profiled, event_id // 10 % 2 + 1 AS version,
event_id // 20 % 2 = 0 AS of_main FROM events)"""


def listed_files(spark: SparkSession, sf: str) -> DataFrame:
    """The files of each user's events, from nested responses of 64 events at most."""
    n = F.col("event_id")
    div = lambda k: F.floor(n / k)
    mod = lambda name: F.struct(F.lit(name).cast("string").alias("mod_abbreviation"))
    scopes = (F.array(mod("WB")), F.array(mod(None)), F.array(mod("FB"), mod("WB")), F.array(mod("FB")))
    m = div(5) % 5
    mods = F.array().cast("array<struct<mod_abbreviation:string>>")
    for i, scope in enumerate(scopes, 1):
        mods = F.when(m == i, scope).otherwise(mods)
    chosen = lambda values: F.get(F.array(*map(F.lit, values)), (n % len(values)).cast("int"))
    file = F.struct(
        n.alias("file_id"), chosen(CLASSES).alias("file_class"), chosen(EXTENSIONS).alias("file_extension"), F.when(div(25) % 2 == 0, "final").otherwise("temp").alias("file_publication_status"),
        F.when(div(5) % 2 == 0, "p1").otherwise("p2").alias("profile_name"), (div(10) % 2 + 1).alias("version"),
        F.struct(F.when(div(20) % 2 == 0, references.MAIN_TEXT).otherwise("other").alias("file_class")).alias("source"), mods.alias("referencefile_mods"),
    )
    responses = table(spark, sf, "events").groupBy(F.col("user_id").alias("curie"), div(64)).agg(F.collect_list(file).alias("files"))
    return references.listed(responses).withColumn("seq", F.col("file_id"))


@query("A03 A05 A06", f"""
WITH {FILES}, r AS (SELECT *, CASE WHEN c = 0 AND m <> 4 THEN 0 WHEN c = 0 THEN 1 WHEN c = 2 AND m <> 4 THEN 2 END AS pref FROM f)
SELECT curie, file_id, CASE WHEN pref < 2 THEN 'md' ELSE 'tei' END AS kind FROM r WHERE pref IS NOT NULL QUALIFY row_number() OVER (PARTITION BY curie ORDER BY pref, file_id) = 1""")
def main_markdown_files(spark: SparkSession, sf: str) -> DataFrame:
    return references.main_markdown(listed_files(spark, sf), "WB").select("curie", "file_id", "kind")


@query("A03 A10", f"""
WITH {FILES}, r AS (SELECT *, CASE WHEN m IN (1, 3) THEN 0 WHEN m = 2 THEN 1 END AS pref FROM f WHERE c = 1 AND final)
SELECT curie, file_id FROM r WHERE pref IS NOT NULL QUALIFY row_number() OVER (PARTITION BY curie ORDER BY pref, file_id) = 1""")
def main_pdf_files(spark: SparkSession, sf: str) -> DataFrame:
    return references.main_pdf(listed_files(spark, sf), "WB").select("curie", "file_id")


@query("A03 A09", f"WITH {FILES} SELECT curie, min(file_id) AS file_id FROM f WHERE c = 2 AND m IN (1, 3) GROUP BY 1")
def scoped_tei_files(spark: SparkSession, sf: str) -> DataFrame:
    return references.tei_files(listed_files(spark, sf), "WB").select("curie", "file_id")


@query("A03 A07", f"WITH {FILES} SELECT curie, file_id, row_number() OVER (PARTITION BY curie ORDER BY file_id) AS n FROM f WHERE c = 3 AND m <> 4")
def supplement_files(spark: SparkSession, sf: str) -> DataFrame:
    return references.supplements(listed_files(spark, sf), "WB").select("curie", "file_id", "n")


@query("A03 A20", f"WITH {FILES} SELECT c.curie, e.file_id FROM (SELECT DISTINCT curie FROM f) c LEFT JOIN (SELECT curie, min(file_id) AS file_id FROM f WHERE c = 4 AND profiled AND version = 2 AND of_main GROUP BY 1) e USING (curie)")
def reference_embedding_files(spark: SparkSession, sf: str) -> DataFrame:
    files = listed_files(spark, sf)
    return references.embedding_files(table(spark, sf, "events").select(F.col("user_id").alias("curie")).distinct(), files, "p1", 2)


@query("A11", """
WITH p AS (SELECT user_id AS curie, event_id, epoch(ts) - min(epoch(ts)) OVER (PARTITION BY user_id) AS elapsed, event_id % 41 = 40 AS bad, CASE event_type WHEN 'purchase' THEN 'converted' WHEN 'error' THEN 'failed' ELSE 'running' END AS status, event_id % 7 = 0 AS ready FROM events
WHERE event_type <> 'purchase' OR event_id % 3 = 0),
o AS (SELECT curie, event_id, CASE WHEN bad THEN 'failed' WHEN status <> 'running' THEN status WHEN ready THEN 'converted' WHEN elapsed >= 3600 THEN 'timeout' END AS outcome FROM p)
SELECT curie, coalesce(arg_min(outcome, event_id) FILTER (WHERE outcome IS NOT NULL), 'running') AS outcome FROM o GROUP BY 1""")
def conversion_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").where("event_type <> 'purchase' OR event_id % 3 = 0")
    at = F.col("ts").cast("timestamp").cast("double")
    first = events.groupBy("user_id").agg(F.min(at).alias("first"))
    n = F.col("event_id")
    polls = events.join(first, "user_id").select(
        F.col("user_id").alias("curie"), n.alias("seq"), (at - F.col("first")).alias("elapsed"), F.when(n % 41 == 40, 500).otherwise(200).alias("http"),
        F.when(F.col("event_type") == "purchase", "converted").when(F.col("event_type") == "error", "failed").otherwise("running").alias("status"),
        F.when(n % 7 == 0, F.array(F.lit(references.MAIN_TEXT))).alias("converted_classes"),
    )
    return references.conversion_outcomes(polls, timeout=3600.0)


@query("B19", """
WITH w AS (SELECT DISTINCT CASE event_id % 4 WHEN 0 THEN 'abc_entity_extractor' WHEN 1 THEN 'abc_document_classifier' WHEN 2 THEN 'abc_literature_system' ELSE 'abc_string_matching_antibody' END AS method, event_type AS mod FROM events),
x AS (SELECT *, CASE method WHEN 'abc_document_classifier' THEN 'ECO:0008004' WHEN 'abc_literature_system' THEN 'ATP:0000036' ELSE 'ECO:0008021' END AS code, mod = 'click' AS there FROM w)
SELECT method, mod, code, CASE WHEN there THEN length(method) ELSE 28 + row_number() OVER (PARTITION BY there ORDER BY mod, method) END AS source_id, NOT there AS created FROM x""")
def tag_source_ids(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*map(F.lit, references.EVIDENCE))
    wanted = table(spark, sf, "events").select(F.get(names, (F.col("event_id") % 4).cast("int")).alias("method"), F.col("event_type").alias("mod"))
    existing = spark.createDataFrame([(m, "click", len(m)) for m in references.EVIDENCE], "method string, mod string, source_id long")
    return references.with_source_ids(wanted, existing)


def write_status(spark: SparkSession, sf: str, present_is_success: bool) -> DataFrame:
    tags = table(spark, sf, "events").select(F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("user_id"), "event_type", "event_id")
    return references.write_results(tags.where("event_id % 50 = 0"), tags, ["user_id", "event_type"], present_is_success=present_is_success)


WRITES = """WITH t AS (SELECT CASE WHEN user_id % 10 <> 0 THEN user_id END AS user_id, event_type, event_id FROM events), g AS (SELECT user_id, event_type, count(CASE WHEN event_id % 50 = 0 THEN 1 END) > 0 AS there FROM t GROUP BY 1, 2)
SELECT user_id, event_type, CASE WHEN user_id IS NULL THEN 'invalid' WHEN there THEN 'exists' ELSE 'created' END AS status, """


@query("B02 B08", WRITES + "user_id IS NOT NULL AS ok FROM g")
def tag_write_results(spark: SparkSession, sf: str) -> DataFrame:
    return write_status(spark, sf, True)


@query("B03", WRITES + "user_id IS NOT NULL AND NOT there AS ok FROM g")
def manual_indexing_results(spark: SparkSession, sf: str) -> DataFrame:
    return write_status(spark, sf, False)


@query("A25 B12", """
WITH r AS (SELECT doc_id, quality, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'AGRKB:' || doc_id END AS curie FROM labels), k AS (SELECT doc_id, coalesce(curie, CASE WHEN doc_id % 2 = 0 THEN 'AGRKB:' || doc_id END) AS curie, quality FROM r)
SELECT curie, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS category FROM k WHERE curie IS NOT NULL AND doc_id >= (SELECT median FROM (SELECT min(doc_id) FILTER (WHERE doc_id % 3 = 1) AS median FROM labels WHERE doc_id > 50))""")
def labels_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    path, labels = shared_folder(spark, "labels"), table(spark, sf, "labels")
    curie = F.concat(F.lit("AGRKB:"), F.col("doc_id").cast("string"))
    xref = F.concat(F.lit("PMID:"), F.col("doc_id").cast("string"))
    sinks.write_csv(labels.select(F.col("doc_id").alias("seq"), F.when(F.col("doc_id") % 3 != 0, curie).alias("curie"), xref.alias("xref"), F.col("quality").alias("label")), path)
    rows = spark.read.schema("seq BIGINT, curie STRING, xref STRING, label STRING").csv(path, header=True)
    start = labels.where("doc_id > 50 AND doc_id % 3 = 1").agg(F.min(F.struct("doc_id", curie.alias("curie"))).alias("m")).select("m.curie").first()[0]
    xrefs = labels.where("doc_id % 2 = 0").select(xref.alias("xref"), curie.alias("curie"))
    return references.labelled_references(rows, xrefs, start).select("curie", "category")


@query("A28", """
SELECT p_partkey, array_to_string(list_distinct(['WBPaper' || lpad(p_partkey::VARCHAR, 8, '0')]), ',') || CASE WHEN p_size % 2 = 0 THEN ',WBPaper' || lpad((p_partkey + 1)::VARCHAR, 8, '0') ELSE '' END AS ids FROM part""")
def paper_list_ids(spark: SparkSession, sf: str) -> DataFrame:
    own, following = [F.lpad((F.col("p_partkey") + i).cast("string"), 8, "0") for i in (0, 1)]
    more = F.when(F.col("p_size") % 2 == 0, F.concat(following, F.lit(" WBPaper"), following)).otherwise("")
    html = F.concat(
        F.lit('<p>WBPaper99999999 <a href="/other?WBPaper88888888">x</a><a class="y" href="/q?a=1&amp;specific_papers=WBPaper'), own, F.lit('">z</a><textarea name="notes">77777777</textarea><textarea rows="2" name="specific_papers">'),
        own, F.lit("\n123 "), more, F.lit(" 123456789</textarea> 66666666"),
    )
    return table(spark, sf, "part").select("p_partkey", F.array_join(text.paper_ids(html), ",").alias("ids"))


@query("A14 A17 A38 B14 B21", "SELECT 'PMID_' || n_nationkey || '.txt' AS file, n_name AS text FROM nation WHERE n_nationkey % 2 = 0")
def text_folder_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path, nation = shared_folder(spark, "texts"), table(spark, sf, "nation")
    name = F.concat(F.lit("AGRKB_"), F.col("n_nationkey").cast("string"))
    sinks.write_text(nation.select(name.alias("curie"), "n_name"), path, "curie", "n_name")
    read = papers.files(spark, path, "*.txt").withColumn("curie", F.regexp_extract("path", "/curie=([^/]+)/", 1))
    pmids = nation.where("n_nationkey % 2 = 0").select(name.alias("curie"), F.concat(F.lit("PMID_"), F.col("n_nationkey").cast("string")).alias("pmid"))
    return read.join(pmids, "curie").select(F.concat("pmid", F.lit(".txt")).alias("file"), F.rtrim(F.regexp_replace("text", r"\n$", "")).alias("text"))


@query("A21", "SELECT CAST(vec_id AS VARCHAR) AS word, round(embedding[1]::DOUBLE, 5) AS first, round(embedding[64]::DOUBLE, 5) AS last, len(embedding)::INTEGER AS dim FROM embeddings")
def word_vectors(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "vectors")
    rows = table(spark, sf, "embeddings")
    header = spark.createDataFrame([("0 64",)], "value string")
    lines = rows.select(F.concat_ws(" ", F.col("vec_id").cast("string"), F.array_join(F.col("embedding").cast("array<string>"), " ")).alias("value"))
    lines.unionByName(header).write.text(path)
    vec = papers.word_vectors(spark.read.text(path), 64)
    return vec.select("word", F.round(F.col("vec")[0].cast("double"), 5).alias("first"), F.round(F.col("vec")[63].cast("double"), 5).alias("last"), F.size("vec").alias("dim"))


@query("A21", "SELECT CAST(vec_id AS VARCHAR) AS word, round(list_sum(embedding)::DOUBLE, 4) + 0.0 AS total, round(embedding[64]::DOUBLE, 5) AS last, len(embedding)::INTEGER AS dim FROM embeddings")
def binary_word_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """All vectors in word2vec's binary form, a thousand or fewer a file, written and parsed again."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                piece = batch.slice(k, 1000)
                whole = papers.as_binary_vectors(list(map(str, piece.column("vec_id").to_pylist())), matrix(piece.column("embedding")))
                yield pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], names=["content"])

    path = shared_folder(spark, "binary-vectors")
    table(spark, sf, "embeddings").select("vec_id", "embedding").mapInArrow(files, "content binary").write.parquet(path)
    vec = papers.binary_vectors(spark.read.parquet(path))
    total = F.aggregate("vec", F.lit(0.0), lambda t, x: t + x.cast("double"))
    return vec.select("word", (F.round(total, 4) + 0.0).alias("total"), F.round(F.col("vec")[63].cast("double"), 5).alias("last"), F.size("vec").alias("dim"))


TREE = """found AS (SELECT 'R' || n_regionkey AS parent, 'N' || n_nationkey AS child FROM nation), baked AS (SELECT 'N' || c_nationkey AS parent, 'C' || c_custkey AS child FROM customer)"""


@query("F20 C17", f"WITH {TREE} SELECT parent, child FROM (SELECT * FROM found UNION SELECT * FROM baked) WHERE child IN (SELECT 'N' || n_nationkey FROM nation WHERE n_nationkey % 3 <> 0) OR child IN (SELECT 'C' || c_custkey FROM customer WHERE c_acctbal > 0)")
def curated_taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    found, baked, curated = tree(spark, sf)
    return taxonomy.edges_or_baked(found, baked, curated)


@query("F20", f"WITH {TREE} SELECT DISTINCT parent, child FROM baked")
def baked_taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    found, baked, curated = tree(spark, sf)
    return taxonomy.edges_or_baked(found.where("false"), baked, curated)


def tree(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    nation, customer = table(spark, sf, "nation"), table(spark, sf, "customer")
    curated = nation.where("n_nationkey % 3 <> 0").select(name("N", "n_nationkey").alias("curie")).unionByName(customer.where("c_acctbal > 0").select(name("C", "c_custkey").alias("curie")))
    found = nation.select(name("R", "n_regionkey").alias("parent"), name("N", "n_nationkey").alias("child"))
    return found, customer.select(name("N", "c_nationkey").alias("parent"), name("C", "c_custkey").alias("child")), curated


@query("A34 F18 F19", """
SELECT c_custkey AS taxid, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS source, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey + 10 END::BIGINT AS parent_tid,
CASE WHEN c_custkey % 3 = 0 THEN '9,5,1' ELSE (c_nationkey + 10) || ',1,5' END AS parents, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN '77,88' ELSE '88' END AS ranks FROM customer""")
def lineage_records(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    near = (F.col("c_nationkey") + 10).cast("string")
    rank = F.when(F.col("c_custkey") % 2 == 0, "no_rank strain").otherwise("species")
    full = F.concat(F.lit('{"taxonomy_nodes":[{"taxonomy":{"rank":"'), rank, F.lit('","parents":[1,5,'), near, F.lit('],"parent_tax_id":"'), near, F.lit('","classification":{"genus":{"id":88},"species":{"id":"77"}}}}]}'))
    first = customer.select(F.col("c_custkey").alias("taxid"), F.lit(1).alias("source"), F.when(F.col("c_custkey") % 3 != 0, full).otherwise('{"taxonomy_nodes":[]}').alias("json"))
    second = customer.select(F.col("c_custkey").alias("taxid"), F.lit(2).alias("source"), F.lit('{"taxonomy_nodes":[{"taxonomy":{"parents":[1,5,9]}}]}').alias("json"))
    chosen = taxonomy.first_lineage(taxonomy.lineage(first.unionByName(second)))
    return chosen.select("taxid", "source", "parent_tid", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("parents", "ranks")])


@query("B07 B20 H10")
def stored_model_scores(spark: SparkSession, sf: str) -> DataFrame:
    data = ml.stratified_split(vector_data(spark, sf), "label", "vec_id")
    fitted = LogisticRegression(regParam=0.01).fit(data.where("not held_out"))
    path = shared_folder(spark, "model")
    stored_models.save_model(fitted, path, {"topic": "halves", "f1": ml.f1(fitted.transform(data.where("held_out")))})
    model, stats = stored_models.load_model(spark, path)
    return ml.predict(model, data.where("held_out")).select("vec_id", "label", "predicted", F.round("score", 6).alias("score"), F.lit(stats["topic"]).alias("topic"), F.round(F.lit(stats["f1"]), 6).alias("f1"))
