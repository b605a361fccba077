"""Queries about vectors, classifiers and evaluation."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators import evaluate, kernels, ml, neighbours, search, vectors
from inkwell.plans.catalog import query
from inkwell.sources.tables import table

DIM, BITS, TABLES = 64, vectors.LSH_BITS, vectors.LSH_TABLES
# A vector's positions and values, for the SQL side.
FLAT = "SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings"


def plane(t: int, b: int) -> str:
    return "[" + ", ".join(map(repr, vectors.projection(DIM, BITS, TABLES)[t, b].tolist())) + "]::DOUBLE[]"


def code(t: int) -> str:
    return " + ".join(f"CASE WHEN list_inner_product(embedding::DOUBLE[], {plane(t, b)}) > 0 THEN {1 << b} ELSE 0 END" for b in range(BITS)) + f" + {t * (1 << BITS)}"


def rounded(vector: str = "embedding", digits: int = 5):
    return F.array_join(F.transform(vector, lambda x: F.format_number(F.round(x, digits) + 0.0, digits)), ",")


@query("E06 A19", f"""
WITH f AS ({FLAT} WHERE vec_id % 10 <> 0), n AS (SELECT vec_id, sqrt(sum(x * x)) AS s FROM f GROUP BY 1), m AS (SELECT label, i, avg(x / s) AS v FROM f JOIN n USING (vec_id) GROUP BY 1, 2),
l AS (SELECT label, sqrt(sum(v * v)) AS s FROM m GROUP BY 1) SELECT label, i AS pos, round(v / s, 6) AS v FROM m JOIN l USING (label)""")
def chunk_mean_pool(spark: SparkSession, sf: str) -> DataFrame:
    chunks = table(spark, sf, "embeddings").select("label", F.col("vec_id").alias("seq"), "embedding", (F.col("vec_id") % 10 == 0).alias("is_document_level"), F.col("vec_id").cast("string").alias("content"))
    pooled = vectors.pooled_chunks(chunks, "label")
    return pooled.select("label", F.posexplode("embedding").alias("p", "v")).select("label", (F.col("p") + 1).alias("pos"), F.round("v", 6).alias("v"))


@query("E07 E08", f"""
WITH f AS ({FLAT}) SELECT label, i AS pos, round(avg(x), 6) AS mean, round(max(x), 6) AS top, round(sum(x * (vec_id + 1)) / sum(vec_id + 1), 6) AS weighted FROM f GROUP BY 1, 2""")
def mean_max_pool(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").withColumn("w", F.col("vec_id") + 1)
    flat = lambda df, name: df.select("label", F.posexplode("embedding").alias("pos", name)).select("label", (F.col("pos") + 1).alias("pos"), F.round(name, 6).alias(name))
    mean, top = flat(vectors.pooled(rows, ["label"], "embedding"), "mean"), flat(vectors.pooled(rows, ["label"], "embedding", "max"), "top")
    return mean.join(top, ["label", "pos"]).join(flat(vectors.pooled(rows, ["label"], "embedding", weight="w"), "weighted"), ["label", "pos"])


@query("E09", "SELECT label, bucket, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT label, {code(t)} AS bucket FROM embeddings" for t in range(TABLES)) + ") GROUP BY 1, 2")
def lsh_bag_of_concepts(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.concept_histogram(table(spark, sf, "embeddings"), "label", "embedding", DIM, bits=BITS, tables=TABLES)


@query("C05 H14", f"""
WITH v AS (SELECT vec_id, max(CASE WHEN x <> 0 THEN 1 ELSE 0 END) = 1 AS ok FROM ({FLAT}) GROUP BY 1) SELECT doc_id, coalesce(v.ok, false) AS valid FROM documents d LEFT JOIN v ON d.doc_id = v.vec_id""")
def valid_embedding_gate(spark: SparkSession, sf: str) -> DataFrame:
    vecs = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "doc_id")
    return vectors.with_missing_as_zero(table(spark, sf, "documents").select("doc_id"), vecs, "doc_id", "embedding", DIM).select("doc_id", "valid")


@query("E20 B13")
def mod_pivot_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """A column for each source, for reports on few of them; ``sparse_mod_matrix`` takes any number."""
    docs = table(spark, sf, "documents")
    mods = [r[0] for r in docs.select("source").where("source is not null").distinct().orderBy("source").collect()]
    return docs.groupBy("lang").pivot("source", mods).agg(F.max(F.lit(1))).na.fill(0, mods)


@query("E20", "SELECT lang, string_agg(DISTINCT source, ',' ORDER BY source) AS mods, count(DISTINCT source) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1")
def sparse_mod_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of the 0/1 matrix of languages and sources by the sources that are 1 in them, however many sources there are."""
    rows = table(spark, sf, "documents").where("source is not null").groupBy("lang", "source").agg(F.lit(1).alias("one"))
    return rows.groupBy("lang").agg(F.array_join(F.array_sort(F.collect_list("source")), ",").alias("mods"), F.count("*").alias("n"))


@query("H01", """
WITH f AS (SELECT vec_id, list_concat([CAST(label AS DOUBLE)], embedding::DOUBLE[], [CAST(vec_id % 7 AS DOUBLE)]) AS f FROM embeddings)
SELECT vec_id, i - 1 AS place, round(f[i], 6) + 0.0 AS value FROM f, range(1, 67) r(i)""")
def assembled_features(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks in their given order: a number, an array and another number."""
    rows = table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("double").alias("label"), "embedding", (F.col("vec_id") % 7).cast("double").alias("last"))
    whole = ml.features(rows, ["label", "embedding", "last"])
    placed = whole.select("vec_id", F.posexplode(vector_to_array("features")).alias("place", "value"))
    return placed.select("vec_id", F.col("place").cast("long").alias("place"), (F.round("value", 6) + 0.0).alias("value"))


SETS = """a AS (SELECT o_custkey AS k, list(DISTINCT o_orderpriority) AS s FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), b AS (SELECT o_custkey AS k, list(DISTINCT o_orderpriority) AS s FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1)"""


def priority_sets(spark: SparkSession, sf: str, odd: int) -> DataFrame:
    return table(spark, sf, "orders").where(F.col("o_orderkey") % 2 == odd).groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("entities"))


@query("E14 D16 A36", f"""
WITH {SETS}, c AS (SELECT len(list_intersect(a.s, b.s)) AS common, len(list_filter(a.s, lambda x: NOT list_contains(b.s, x))) AS only_a, len(list_filter(b.s, lambda x: NOT list_contains(a.s, x))) AS only_b FROM a JOIN b USING (k)),
t AS (SELECT sum(common)::BIGINT AS common, sum(only_a)::BIGINT AS only_found, sum(only_b)::BIGINT AS only_expected, count(*) AS compared, count(CASE WHEN only_a + only_b = 0 THEN 1 END) AS exact FROM c)
SELECT *, 100.0 * common / (common + only_found + only_expected) AS pct_common, 100.0 * only_found / (common + only_found + only_expected) AS pct_found, 100.0 * only_expected / (common + only_found + only_expected) AS pct_expected, exact::DOUBLE / compared AS exact_rate FROM t""")
def set_comparison_stats(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.set_statistics(priority_sets(spark, sf, 0), priority_sets(spark, sf, 1), "o_custkey")


@query("B15 F08", f"""
WITH {SETS} SELECT a.k AS o_custkey, len(list_intersect(a.s, b.s)) AS n_common, array_to_string(list_sort(list_filter(a.s, lambda x: NOT list_contains(b.s, x))), ' | ') AS only_found,
array_to_string(list_sort(list_filter(b.s, lambda x: NOT list_contains(a.s, x))), ' | ') AS only_expected, len(list_filter(a.s, lambda x: NOT list_contains(b.s, x))) + len(list_filter(b.s, lambda x: NOT list_contains(a.s, x))) AS n
FROM a JOIN b USING (k) WHERE len(list_intersect(a.s, b.s)) < greatest(len(a.s), len(b.s))""")
def set_differences(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.differences(priority_sets(spark, sf, 0), priority_sets(spark, sf, 1), "o_custkey")


SWEEP = """
WITH s AS (SELECT user_id AS k, lower(props) AS name, max(value / 20) AS score FROM events WHERE event_type = 'click' GROUP BY 1, 2), g AS (SELECT DISTINCT user_id AS k, lower(props) AS name FROM events WHERE event_type = 'purchase'),
m AS (SELECT coalesce(s.k, g.k) AS k, score, g.k IS NOT NULL AS gold FROM s FULL JOIN g ON s.k = g.k AND s.name = g.name), t AS (SELECT i / 10.0 AS threshold FROM range(1, 51) r(i)),
b AS (SELECT threshold, k, count(CASE WHEN coalesce(score >= threshold, false) AND gold THEN 1 END) AS c, count(CASE WHEN coalesce(score >= threshold, false) OR gold THEN 1 END) AS u FROM m, t GROUP BY 1, 2),
w AS (SELECT threshold::DOUBLE AS threshold, round(avg(c / u), 9) AS similarity FROM b WHERE u > 0 GROUP BY 1) """


def sweep(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    scored = events.where("event_type = 'click'").select(F.col("user_id").alias("k"), F.col("props").alias("name"), (F.col("value") / 20).alias("score"))
    gold = events.where("event_type = 'purchase'").select(F.col("user_id").alias("k"), F.col("props").alias("name"))
    swept = evaluate.threshold_sweep(scored, gold, "k", [i / 10 for i in range(1, 51)])
    return swept.withColumn("similarity", F.round("similarity", 9))


@query("E13", SWEEP + "SELECT * FROM w")
def jaccard_threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return sweep(spark, sf)


@query("F06 E13", SWEEP + "SELECT * FROM w ORDER BY similarity DESC, threshold LIMIT 1")
def best_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.best_threshold(sweep(spark, sf))


@query("E15", """
WITH p AS (SELECT quality AS y, CASE WHEN n_chars > 800 THEN 1 ELSE 0 END AS q FROM labels JOIN documents USING (doc_id)), c AS (SELECT unnest([0, 1]) AS class),
t AS (SELECT class, count(CASE WHEN y = class THEN 1 END) AS support, count(CASE WHEN q = class THEN 1 END) AS predicted, count(CASE WHEN y = class AND q = class THEN 1 END) AS hit FROM c, p GROUP BY 1)
SELECT class, support, round(p, 9) AS precision, round(r, 9) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 9) AS f1 FROM (SELECT *, coalesce(hit / nullif(predicted, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r FROM t)""")
def precision_recall_f1(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    scored = ml.confusion(joined.withColumn("predicted", F.when(F.col("n_chars") > 800, 1).otherwise(0)), "quality", "predicted")
    return scored.select("class", "support", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query("H09 F05", """
WITH m AS (SELECT CAST(user_id AS VARCHAR) AS name, avg(value) / 100 AS test, avg(CASE WHEN event_type = 'click' THEN value END) / 100 AS cv FROM events GROUP BY 1 HAVING cv IS NOT NULL),
p AS (SELECT name, 0.7 * test + 0.3 * cv - 2 * greatest(0, cv - test - 0.05) AS score FROM m) SELECT name, round(score, 9) AS score, row_number() OVER (ORDER BY round(score, 9) DESC, name) AS rank FROM p""")
def penalized_model_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Every user's mean value as a test score, that of the clicks as one of cross-validation."""
    clicks = F.avg(F.when(F.col("event_type") == "click", F.col("value"))) / 100
    scores = table(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("name")).agg((F.avg("value") / 100).alias("test"), clicks.alias("cv")).where("cv is not null")
    return ml.ranked_models(scores).select("name", "score", "rank")


def class_ranks(table: str, label: str, key: str, seed: int = ml.SEED) -> str:
    """The shuffled order of each class (r, from 1) and its size (n), in SQL: that of the MD5's first half, as a signed number."""
    digits = f"substr(md5({key} || ':{seed}'), 1, 16)"
    return f"SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {digits} < '8', {digits}, {key}) AS r, count(*) OVER (PARTITION BY {label}) AS n FROM {table}"


@query("H04", f"SELECT doc_id, quality AS label FROM ({class_ranks('labels', 'quality', 'doc_id')}) WHERE quality <> 1 OR r <= (SELECT count(*) FROM labels WHERE quality = 0)")
def stratified_undersample(spark: SparkSession, sf: str) -> DataFrame:
    rows = ml.undersampled(table(spark, sf, "labels"), "quality", "doc_id", large=1, like=0)
    return rows.select("doc_id", F.col("quality").alias("label"))


@query("H02", f"SELECT doc_id, quality AS label, r <= round(n * 0.2) AS held_out FROM ({class_ranks('labels', 'quality', 'doc_id')})")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return ml.stratified_split(table(spark, sf, "labels"), "quality", "doc_id").select("doc_id", F.col("quality").alias("label"), "held_out")


@query("H05", f"SELECT doc_id, quality AS label, CAST((r - 1) % 5 AS INT) AS fold FROM ({class_ranks('labels', 'quality', 'doc_id')})")
def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    return ml.folds(table(spark, sf, "labels"), "quality", "doc_id").select("doc_id", F.col("quality").alias("label"), "fold")


@query("F10", f"SELECT event_type, event_id FROM ({class_ranks('events', 'event_type', 'event_id', 7)}) WHERE r <= 10")
def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    ranked = ml.with_class_rank(table(spark, sf, "events").select("event_type", "event_id"), "event_type", "event_id", 7, ml.md5_order("event_id", 7))
    return ranked.where("__r <= 10").select("event_type", "event_id")


def vector_data(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", F.when(F.col("label") < 5, 1).otherwise(0).alias("label"))
    return ml.features(rows, ["embedding"])


@query("H12 C06")
def classify_with_logreg(spark: SparkSession, sf: str) -> DataFrame:
    data = ml.stratified_split(vector_data(spark, sf), "label", "vec_id")
    model = LogisticRegression(regParam=0.01).fit(data.where("not held_out"))
    return ml.predict(model, data.where("held_out")).select("vec_id", "label", "predicted", F.round("score", 6).alias("score"))


@query("H07 H12", """
WITH e AS (SELECT vec_id, CAST(label < 5 AS INT) AS label, embedding::DOUBLE[] AS v FROM embeddings),
n AS (SELECT a.vec_id, a.label, b.label AS other, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS r FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT vec_id, label, CAST(avg(other) >= 0.5 AS INT) AS predicted, round(avg(other), 6) AS score FROM n WHERE r <= 9 GROUP BY 1, 2""")
def classify_by_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """Every row by the votes of the nine others nearest to it."""
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("__id"), F.col("embedding").cast("array<double>").alias("v"), F.when(F.col("label") < 5, 1).otherwise(0).cast("long").alias("y"))
    index = neighbours.CellIndex.build(rows)
    near = index.nearest(rows, 9, apart=0)
    score = neighbours.votes(F.col("near"), 2)[1]
    voted = near.select(F.col("__id").alias("vec_id"), score.alias("score"))
    return rows.select(F.col("__id").alias("vec_id"), F.col("y").cast("int").alias("label")).join(voted, "vec_id").select("vec_id", "label", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.round("score", 6).alias("score"))


@query("H07 H12")
def classify_with_kernel(spark: SparkSession, sf: str) -> DataFrame:
    """Support vectors with a radial kernel: a linear classifier on the kernel's features, fitted on a bounded sample, for every row."""
    data = vector_data(spark, sf)
    training = search.sampled(data, "vec_id", search.MOST_ROWS)
    model = Pipeline(stages=[kernels.RadialFeatures(), LinearSVC(featuresCol="kernel", regParam=0.001, standardization=False)]).fit(training)
    return ml.predict(model, data).select("vec_id", "label", "predicted", F.round("score", 6).alias("score"))


@query("H11 H13 H04")
def classify_priorities(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding", (F.col("label") % 3).alias("label"))
    data = ml.features(rows, ["embedding"])
    found = search.priority_search(data, "vec_id")
    return ml.predict_class(found.model, data).select("vec_id", "label", "predicted", F.round("score", 6).alias("score"))


#: Families whose settings and folds share their passes; those of trees take jobs for each setting and fold.
SEARCHED, TREES = ["LogisticRegression", "LinearSVC", "SVC", "KNeighborsClassifier", "SGDClassifier"], ["DecisionTreeClassifier"]


def searched(spark: SparkSession, sf: str, families: list[str]) -> DataFrame:
    scores = search.random_search(vector_data(spark, sf), "vec_id", families)
    rows = [(s.family, str(s.settings), s.cv, float(np.std(s.folds)), s.test, s.cv - s.test, s.penalised, rank) for rank, s in enumerate(scores, 1)]
    return spark.createDataFrame(rows, "family string, settings string, cv_mean double, cv_std double, test double, gap double, score double, rank int")


@query("H05 H06 H08 H09 H10 F05")
def model_selection(spark: SparkSession, sf: str) -> DataFrame:
    return searched(spark, sf, SEARCHED)


@query("H06")
def tree_selection(spark: SparkSession, sf: str) -> DataFrame:
    return searched(spark, sf, TREES)


@query("H03")
def outlier_removal(spark: SparkSession, sf: str) -> DataFrame:
    data = vector_data(spark, sf)
    kept = [(m or "none", ml.without_outliers(data, m).count(), data.count()) for m in ("elliptic", "forest", "lof", None)]
    return spark.createDataFrame(kept, "method string, kept long, total long")


@query("E10")
def hashed_bag_of_words(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.bag_of_words(table(spark, sf, "documents").select("doc_id", "text"), "text").select("doc_id", "bow")
