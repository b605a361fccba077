"""Queries about jobs, tags, files and the tables around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import dates, levels
from inkwell.operators import picks
from inkwell.plans.catalog import query
from inkwell.sources.tables import table

LONG = "long"


@query("A01 F09", "SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('click', 'error') ORDER BY event_id LIMIT 100 OFFSET 50")
def paged_job_scan(spark: SparkSession, sf: str) -> DataFrame:
    jobs = table(spark, sf, "events").where(F.col("event_type").isin("click", "error"))
    return jobs.select("event_id", "user_id", "event_type").orderBy("event_id").offset(50).limit(100)


@query("A02 C01 F01 E25", """
SELECT event_id, user_id, event_type, mod_id FROM (
  SELECT *, CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id % 5 END AS mod_id,
         row_number() OVER (PARTITION BY CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id % 5 END, event_type, user_id ORDER BY event_id) AS rn
  FROM events) t WHERE rn = 1 AND mod_id IS NOT NULL""")
def jobs_dedup_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    jobs = table(spark, sf, "events").withColumn("mod_id", F.when(F.col("user_id") % 7 != 0, F.col("user_id") % 5))
    kept = picks.first_wins(jobs, ["mod_id", "event_type", "user_id"], ["event_id"], drop_null_keys=["mod_id", "event_type"])
    return kept.select("event_id", "user_id", "event_type", "mod_id")


@query("E01", "SELECT event_type, user_id % 5 AS mod_id, count(*) AS n_jobs FROM events GROUP BY 1, 2")
def jobs_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("event_type", (F.col("user_id") % 5).alias("mod_id")).agg(F.count("*").alias("n_jobs"))


@query("B05 A39", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) t WHERE rn = 1")
def latest_job_state(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return picks.latest_state(events, "user_id", "event_id").select("user_id", "event_id", "event_type")


@query("F02 F03", """
SELECT DISTINCT ON (l_orderkey) l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem WHERE l_returnflag IN ('R', 'A')
ORDER BY l_orderkey, CASE l_returnflag WHEN 'R' THEN 0 ELSE 1 END, l_linenumber, l_partkey""")
def distinct_on_pick(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    flag = F.col("l_returnflag")
    return picks.prefer(lines, ["l_orderkey"], [flag == "R", flag == "A"], ["l_linenumber", "l_partkey"])


@query("D05 F13 C16", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_documents_anti(spark: SparkSession, sf: str) -> DataFrame:
    return picks.missing(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), ["doc_id"])


@query("D06 D07", "SELECT d.doc_id, d.source, l.quality FROM documents d JOIN labels l USING (doc_id)")
def files_with_jobs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")


@query("D08 C18", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def semi_join_in_subquery(spark: SparkSession, sf: str) -> DataFrame:
    rich = table(spark, sf, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(rich, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("D09 D10", """
SELECT DISTINCT c.c_custkey, n.n_name, r.r_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey WHERE o.o_orderstatus = 'F'""")
def multiway_distinct_join(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    joined = orders.where("o_orderstatus = 'F'").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    joined = joined.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("c_custkey", "n_name", "r_name").distinct()


@query("B09 D17 D19", """
SELECT o.o_orderkey, o.o_orderstatus, coalesce(e.v, o.o_totalprice) AS o_totalprice FROM orders o
LEFT JOIN (SELECT user_id AS k, max(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY 1) e ON o.o_orderkey = e.k""")
def update_from_join(spark: SparkSession, sf: str) -> DataFrame:
    new = table(spark, sf, "events").where("event_type = 'purchase'").groupBy(F.col("user_id").alias("o_orderkey")).agg(F.max("value").alias("v"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return picks.updated(orders, new, ["o_orderkey"], "o_totalprice", "v")


@query("A06 F03", """
SELECT user_id, event_id, scope FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN scope = 'M1' THEN 0 WHEN scope IS NULL THEN 1 ELSE 2 END, event_id) AS rn FROM (
    SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN 'M1' ELSE 'M2' END AS scope FROM events WHERE event_type = 'click') s) t
WHERE rn = 1""")
def prefer_scoped_then_global(spark: SparkSession, sf: str) -> DataFrame:
    scope = F.when(F.col("event_id") % 3 == 1, "M1").when(F.col("event_id") % 3 == 2, "M2")
    files = table(spark, sf, "events").where("event_type = 'click'").select("user_id", "event_id", scope.alias("scope"))
    files = files.withColumn("mods", F.when(F.col("scope").isNull(), F.array().cast("array<struct<mod_abbreviation:string>>")).otherwise(F.array(F.struct(F.col("scope").alias("mod_abbreviation")))))
    own = picks.strictly_in_scope("mods", "M1")
    return picks.prefer(files, ["user_id"], [own, picks.in_scope("mods", "M1"), F.lit(True)], ["event_id"]).select("user_id", "event_id", "scope")


@query("C07", "SELECT event_id FROM events WHERE event_type = 'click' AND event_id % 3 = 1")
def strict_scope(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "events").where("event_type = 'click'")
    named = F.when(F.col("event_id") % 3 == 1, "M1").when(F.col("event_id") % 3 == 2, "M2")
    files = files.withColumn("mods", F.array(F.struct(named.alias("mod_abbreviation"))))
    return files.where(picks.strictly_in_scope("mods", "M1")).select("event_id")


@query("F04", "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE event_type = 'view'")
def numbered_supplements(spark: SparkSession, sf: str) -> DataFrame:
    views = table(spark, sf, "events").where("event_type = 'view'").select("user_id", "event_id")
    return picks.numbered(views, ["user_id"], ["event_id"])


@query("A08 E17", """
SELECT count(*) AS requested, count(CASE WHEN l.doc_id IS NOT NULL THEN 1 END) AS written, count(CASE WHEN l.doc_id IS NULL THEN 1 END) AS missing
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def fetch_summary(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("found"))
    joined = table(spark, sf, "documents").select("doc_id").join(found, "doc_id", "left")
    return joined.agg(F.count("*").alias("requested"), F.count_if("found").alias("written"), F.count_if(F.col("found").isNull()).alias("missing"))


@query("C13 F08", """
SELECT event_id, user_id, CASE WHEN value = 0 THEN 'neg' WHEN value < 0.667 THEN 'low' WHEN value < 0.833 THEN 'medium' ELSE 'high' END AS level
FROM events WHERE ts >= DATE '2024-01-24' AND ts < DATE '2024-01-31' AND value IS NOT NULL""")
def recent_tags_export(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.to_date(F.lit("2024-01-30"))
    recent = table(spark, sf, "events").where((F.col("ts") >= F.date_sub(as_of, 6)) & (F.col("ts") < F.date_add(as_of, 1)) & F.col("value").isNotNull())
    return recent.select("event_id", "user_id", levels.export_level(F.col("value")).alias("level"))


@query("A24", """
WITH t AS (SELECT o_custkey AS dataset, year(o_orderdate) AS version, o_orderkey FROM orders)
SELECT t.dataset, t.version, count(*) AS n FROM t JOIN (
  SELECT dataset, coalesce(max(CASE WHEN version = 1997 THEN version END), max(version)) AS wanted FROM t GROUP BY 1) w ON t.dataset = w.dataset AND t.version = w.wanted
GROUP BY 1, 2""")
def training_set_version(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("dataset"), F.year("o_orderdate").alias("version"))
    counted = rows.groupBy("dataset", "version").agg(F.count("*").alias("n"))
    wanted = counted.groupBy("dataset").agg(F.coalesce(F.max(F.when(F.col("version") == 1997, F.col("version"))), F.max("version")).alias("version"))
    return counted.join(wanted, ["dataset", "version"]).select("dataset", "version", "n")


@query("A35 D02", """
SELECT c_custkey, coalesce(n_name, 'unknown') AS species, CASE WHEN c_mktsegment LIKE 'B%' THEN c_mktsegment END AS pmid FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20""")
def id_lookups(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").where("n_nationkey < 20").withColumnRenamed("n_nationkey", "c_nationkey")
    refs = F.filter(F.array("c_mktsegment", "c_name"), lambda x: x.startswith("B"))
    joined = table(spark, sf, "customer").join(nation, "c_nationkey", "left")
    return joined.select("c_custkey", F.coalesce("n_name", F.lit("unknown")).alias("species"), F.get(refs, F.lit(0)).alias("pmid"))


@query("A37 D18 E23", """
SELECT event_type AS topic, user_id % 5 AS mod_id, count(*) AS n, CASE WHEN user_id % 5 = 4 THEN 'no model' END AS reason FROM events GROUP BY ALL""")
def jobs_with_models(spark: SparkSession, sf: str) -> DataFrame:
    models = spark.createDataFrame([(m, 100 + m) for m in range(4)], "mod_id long, ml_model_id long")
    jobs = table(spark, sf, "events").select(F.col("event_type").alias("topic"), (F.col("user_id") % 5).alias("mod_id"))
    joined = jobs.join(F.broadcast(models), "mod_id", "left")
    return joined.groupBy("topic", "mod_id", F.when(F.col("ml_model_id").isNull(), "no model").alias("reason")).agg(F.count("*").alias("n"))


@query("B01 B06", """
SELECT user_id, event_type, min(event_id) AS event_id FROM events e WHERE event_type <> 'click'
AND NOT EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.event_type = e.event_type AND x.event_id < 2000) GROUP BY 1, 2""")
def idempotent_tag_append(spark: SparkSession, sf: str) -> DataFrame:
    tags = table(spark, sf, "events").select("user_id", "event_type", "event_id").where("event_type <> 'click'")
    new = tags.groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))
    return picks.append_new(tags.where("event_id < 2000"), new, ["user_id", "event_type"])


@query("B04", "SELECT e.user_id, coalesce(p.value, 0.0) AS confidence_score FROM (SELECT DISTINCT user_id FROM events) e LEFT JOIN (SELECT user_id, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1) p USING (user_id)")
def priority_writes(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    scores = events.where("event_type = 'purchase'").groupBy("user_id").agg(F.max("value").alias("value"))
    return events.select("user_id").distinct().join(scores, "user_id", "left").select("user_id", F.coalesce("value", F.lit(0.0)).alias("confidence_score"))


@query("B22", "SELECT event_type, CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-09') AS BIGINT) AS age, date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-09') > 7 AS stale FROM events GROUP BY 1")
def export_freshness(spark: SparkSession, sf: str) -> DataFrame:
    age = F.datediff(F.lit("2024-02-09").cast("date"), F.max("ts").cast("date")).cast(LONG)
    return table(spark, sf, "events").groupBy("event_type").agg(age.alias("age"), (age > 7).alias("stale"))


@query("C02 C07", "SELECT event_id, event_type, upper(event_type) AS mod FROM events WHERE upper(event_type) IN ('CLICK', 'VIEW') AND value IS NOT NULL AND user_id NOT IN (1, 2, 3)")
def job_filter(spark: SparkSession, sf: str) -> DataFrame:
    mod = F.upper("event_type")
    excluded = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    kept = table(spark, sf, "events").where(mod.isin("CLICK", "VIEW") & F.col("value").isNotNull())
    return kept.join(F.broadcast(excluded), "user_id", "left_anti").select("event_id", "event_type", mod.alias("mod"))


@query("C03", """
WITH d AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'no date here' WHEN event_id % 4 = 1 THEN strftime(ts, '%Y-%m-%d') WHEN event_id % 4 = 2 THEN strftime(ts, '%Y-%m') ELSE strftime(ts, '%Y') END AS raw, ts FROM events)
SELECT event_id, raw, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(ts AS DATE) WHEN 2 THEN CAST(date_trunc('month', ts) AS DATE) ELSE CAST(date_trunc('year', ts) AS DATE) END AS parsed FROM d
WHERE event_id % 4 = 0 OR CASE event_id % 4 WHEN 1 THEN CAST(ts AS DATE) WHEN 2 THEN CAST(date_trunc('month', ts) AS DATE) ELSE CAST(date_trunc('year', ts) AS DATE) END >= DATE '2024-01-15'""")
def date_floor_keep_unparseable(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_id") % 4
    raw = F.when(kind == 0, "no date here").when(kind == 1, F.date_format("ts", "yyyy-MM-dd")).when(kind == 2, F.date_format("ts", "yyyy-MM")).otherwise(F.date_format("ts", "yyyy"))
    parsed = table(spark, sf, "events").select("event_id", raw.alias("raw")).withColumn("parsed", dates.reference_date(F.col("raw")))
    return parsed.where(picks.keep_unknown_dates(F.col("parsed"), F.lit("2024-01-15").cast("date")))


@query("C04 E16", "SELECT quality AS label, count(*) AS n FROM labels GROUP BY 1")
def class_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").groupBy(F.col("quality").alias("label")).agg(F.count("*").alias("n"))


@query("C06 C19", """
SELECT doc_id, CASE WHEN source = 'src1' THEN 'NCBITaxon:' || CAST(doc_id AS VARCHAR) END AS species FROM labels JOIN documents USING (doc_id) WHERE quality = 1 OR lang = 'en'""")
def tag_gate(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id")
    named = F.concat(F.when(F.col("source") == "src1", "NCBITaxon:").otherwise("use default "), F.col("doc_id").cast("string"))
    return joined.where(levels.tag_wanted(F.col("quality"), F.col("lang") == "en")).select("doc_id", levels.taxon_species(named).alias("species"))


@query("C09", "SELECT conv_id, string_agg(text, ' ' ORDER BY CASE role WHEN 'user' THEN 0 ELSE 1 END, turn) AS fulltext FROM conversations GROUP BY 1")
def section_concat(spark: SparkSession, sf: str) -> DataFrame:
    part = F.struct(F.when(F.col("role") == "user", 0).otherwise(1).alias("o"), "turn", "text")
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("s"))
    return turns.select("conv_id", F.array_join(F.transform("s", lambda x: x["text"]), " ").alias("fulltext"))


@query("E16", "SELECT trim(split_part(o_orderpriority, '-', 2)) AS reason, count(*) AS n FROM orders GROUP BY 1")
def reason_histogram(spark: SparkSession, sf: str) -> DataFrame:
    reason = F.trim(F.split("o_orderpriority", "-")[1])
    return table(spark, sf, "orders").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("E23 F08", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2 ORDER BY n DESC, 1, 2")
def skipped_totals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where("o_orderstatus <> 'F'").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_orderstatus", "o_orderpriority")


@query("F11 F12 F13", """
WITH q AS (SELECT doc_id FROM labels WHERE quality = 1), t AS (SELECT doc_id FROM labels WHERE toxic = 1), u AS (SELECT doc_id FROM q UNION SELECT doc_id FROM t)
SELECT doc_id, 'both' AS part FROM (SELECT doc_id FROM q INTERSECT SELECT doc_id FROM t) UNION ALL SELECT doc_id, 'quality' FROM (SELECT doc_id FROM q EXCEPT SELECT doc_id FROM t) UNION ALL SELECT doc_id, 'any' FROM u""")
def union_intersect_except(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels")
    q, t = labels.where("quality = 1").select("doc_id"), labels.where("toxic = 1").select("doc_id")
    part = lambda df, name: df.select("doc_id", F.lit(name).alias("part"))
    return part(q.intersect(t), "both").unionByName(part(q.subtract(t), "quality")).unionByName(part(q.union(t).distinct(), "any"))


@query("confidence_levels C06", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'NEG' WHEN value / 100 < 0.667 THEN 'LOW' WHEN value / 100 < 0.833 THEN 'MEDIUM' ELSE 'HIGH' END AS classifier,
event_type || CASE WHEN value / 100 < 0.5 THEN '-LOW' WHEN value / 100 < 0.75 THEN '-MEDIUM' ELSE '-HIGH' END AS priority,
CASE WHEN value / 100 > 0.7 THEN 'HIGH' WHEN value / 100 > 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS gene FROM events WHERE value IS NOT NULL""")
def confidence_levels(spark: SparkSession, sf: str) -> DataFrame:
    score = F.col("value") / 100
    label = F.when(F.col("event_type") == "error", 0).otherwise(1)
    return table(spark, sf, "events").where("value is not null").select("event_id", levels.classifier_level(label, score).alias("classifier"), levels.priority_level(F.col("event_type"), score).alias("priority"), levels.gene_level(score).alias("gene"))
