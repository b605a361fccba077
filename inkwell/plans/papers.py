"""Queries about papers' files, alleles, exports, sinks and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import alleles, levels, text
from inkwell.plans.catalog import query
from inkwell.sources import papers, sinks, tei
from inkwell.sources.storage import shared_folder
from inkwell.sources.tables import table
from inkwell.streaming import jobs as streams

@query("A16 A17 C09 H01", r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l, coalesce(lang, '') AS lang FROM documents),
n AS (SELECT doc_id, 'A title of ' || doc_id AS title, [trim(regexp_replace(regexp_replace(x, '\*\*([^*]+)\*\*|\*([^*]+)\*|__([^_]+)__|`([^`]+)`', '\1\2\3\4', 'g'), '\s+', ' ', 'g'))
 for x in ['Some bold ' || lang || ' abstract.', l[1], array_to_string(l[2:len(l)], chr(10))]] AS parts FROM d)
SELECT doc_id, title, array_to_string([x for x in parts if x <> ''], ' ') AS fulltext FROM n""")
def markdown_fulltext(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as Markdown of a title, an abstract, two sections and references, read back."""
    docs, line = table(spark, sf, "documents"), "\n"
    text_, cut = F.coalesce("text", F.lit("")), F.locate(line, F.coalesce("text", F.lit("")))
    first = F.when(cut > 0, F.substring(text_, F.lit(1), cut - 1)).otherwise(text_)
    rest = F.when(cut > 0, F.substring(text_, cut + 1, F.length(text_))).otherwise("")
    own = F.concat(
        F.lit("# A *title* of "), F.col("doc_id").cast("string"), F.lit(f"{line}{line}Some **bold** "), F.coalesce("lang", F.lit("")), F.lit(f" abstract.{line}{line}## Introduction{line}"),
        first, F.lit(f"{line}{line}### Methods{line}"), rest, F.lit(f"{line}{line}## References{line}{line}1. Old paper."),
    )
    sections = papers.markdown_sections(docs.select("doc_id", own.alias("text")), "doc_id")
    title = sections.where("ord = 1").select("doc_id", F.col("section").alias("title"))
    return title.join(papers.fulltext(sections, "doc_id"), "doc_id")


@query("A14 A15 A17 B14", "SELECT doc_id, text FROM documents")
def files_with_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's bytes, of odd ones as Latin-1, as text again."""
    docs = table(spark, sf, "documents")
    content = F.when(F.col("doc_id") % 2 == 1, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    return docs.select("doc_id", papers.text_of(content).alias("text"))


@query("A15 F08", """
WITH f AS (SELECT p_partkey, p_brand AS stem, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size * 10 + p_partkey % 10 END AS number, p_brand || '.supp_' || CASE WHEN p_size % 7 = 0 THEN 'x' || p_partkey ELSE CAST(p_size * 10 + p_partkey % 10 AS VARCHAR) END || '.md' AS name FROM part WHERE p_size <> 1)
SELECT name, row_number() OVER (PARTITION BY stem ORDER BY number NULLS LAST, name) AS ord FROM f""")
def supplement_order(spark: SparkSession, sf: str) -> DataFrame:
    """Files of each brand: numbered supplements, malformed ones, and main files."""
    part, size = table(spark, sf, "part"), F.col("p_size")
    number = F.when(size % 7 == 0, F.concat(F.lit("x"), F.col("p_partkey").cast("string"))).otherwise((size * 10 + F.col("p_partkey") % 10).cast("string"))
    name = F.when(size == 1, F.concat("p_brand", F.lit(".md"))).otherwise(F.concat("p_brand", F.lit(".supp_"), number, F.lit(".md")))
    return papers.supplements(part.select(name.alias("name"))).select("name", "ord")


TEI = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(n_chars, 0) AS n_chars, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
o AS (SELECT doc_id, lang || ' ' || source AS title, doc_id || ' of ' || n_chars AS abstract, [doc_id::VARCHAR, 'of ' || n_chars]
 || list_transform(list_filter(range(len(l)), lambda i: i % 4 IN (0, 3)), lambda i: CASE WHEN i % 4 = 3 THEN 'see x' || i || ' ' ELSE '' END || l[i + 1])
 || list_transform(list_filter(range(len(l)), lambda i: i % 4 = 3), lambda i: 'x' || i)
 || list_transform(list_filter(range(len(l)), lambda i: i % 4 = 1), lambda i: l[i + 1] || ' and more')
 || list_transform(list_filter(range(len(l)), lambda i: i % 4 = 2), lambda i: l[i + 1]) || ['Section'] AS parts FROM d),
t AS (SELECT doc_id, title, abstract, array_to_string(list_transform(list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), lambda x: CASE WHEN ends_with(x, '.') THEN x ELSE x || '.' END), ' ') AS fulltext FROM o)
SELECT doc_id, trim(regexp_replace(regexp_replace(title, '[<>\[\]]+', ' ', 'g'), '\s+', ' ', 'g')) AS title, abstract, trim(regexp_replace(regexp_replace(fulltext, '[<>\[\]]+', ' ', 'g'), '\s+', ' ', 'g')) AS fulltext FROM t"""


def tei_documents(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, xml: every document as TEI, its lines in turn as paragraphs, items, notes and paragraphs with formulas."""
    escaped = lambda c: F.replace(F.replace(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    docs = table(spark, sf, "documents")
    n = lambda i: i.cast("string")

    def element(line, i):
        paragraph = F.concat(F.lit("<p xml:id='a/"), n(i), F.lit("'>"), line, F.lit("</p>"))
        item = F.concat(F.lit("<list><item><p>"), line, F.lit("</p> and more</item></list>"))
        note = F.concat(F.lit("<note place='foot'><p>"), line, F.lit("</p></note>"))
        formula = F.concat(F.lit("<p>see <formula notation='a/b'>x"), n(i), F.lit("</formula> "), line, F.lit("</p>"))
        return F.when(i % 4 == 0, paragraph).when(i % 4 == 1, item).when(i % 4 == 2, note).otherwise(formula)

    body = F.array_join(F.transform(F.split(escaped(F.col("text")), "\n"), element), "")
    head = F.concat(F.lit("<TEI><teiHeader><fileDesc><titleStmt><title level='a'>"), escaped(F.col("lang")), F.lit(" <hi rend='i'>"), escaped(F.col("source")), F.lit("</hi></title></titleStmt></fileDesc>"))
    own = F.concat(F.lit("<abstract><p>"), escaped(F.col("doc_id")), F.lit("</p><p>of <b>"), F.coalesce("n_chars", F.lit(0)).cast("string"), F.lit("</b></p></abstract></teiHeader>"))
    return docs.select("doc_id", F.concat(head, own, F.lit("<text><body><div><head>Section</head>"), body, F.lit("</div></body></text></TEI>")).alias("xml"))


@query("A18 G07 G08", TEI)
def tei_reader(spark: SparkSession, sf: str) -> DataFrame:
    return tei.tei(tei_documents(spark, sf), "xml").select("doc_id", "title", "abstract", "fulltext")


@query("D11 C11", """
WITH t AS (SELECT user_id AS k, event_type AS token, event_id AS pos FROM events), s AS (SELECT user_id AS k, min(event_id) AS a, max(event_id) AS b FROM events GROUP BY 1)
SELECT k, token FROM t JOIN s USING (k) GROUP BY 1, 2 HAVING bool_and(pos >= a AND pos < b)""")
def tokens_inside_spans(spark: SparkSession, sf: str) -> DataFrame:
    return inside_spans(spark, sf)


def inside_spans(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(F.col("user_id").alias("k"), F.col("event_type").alias("token"), F.col("event_id").alias("pos"))
    # Two spans that meet, up to each user's last event, which is outside.
    ends = events.groupBy("k").agg(F.min("pos").alias("first"), F.max("pos").alias("last")).withColumn("middle", F.expr("(first + last) div 2"))
    cut = ends.select("k", F.col("first").alias("start"), F.col("middle").alias("end"))
    rest = ends.select("k", F.col("middle").alias("start"), F.col("last").alias("end"))
    return papers.page_only(events, cut.unionByName(rest), "k")


@query("A12 A13 A38", """
SELECT c_custkey, 'title' AS field, c_name || ' of|' || c_mktsegment AS content FROM customer UNION ALL SELECT c_custkey, 'abstract', 'From ' || c_nationkey FROM customer""")
def bib_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A bib file of every customer, written and read back line by line."""
    path = shared_folder(spark, "bib")
    lines = F.concat_ws("\n", F.concat(F.lit("title| "), "c_name", F.lit(" of|"), "c_mktsegment", F.lit(" ")), F.concat(F.lit("abstract|From "), F.col("c_nationkey").cast("string")), F.lit("no pipe"))
    table(spark, sf, "customer").select("c_custkey", F.explode(F.split(lines, "\n")).alias("value")).write.parquet(path)
    return papers.bib(spark.read.parquet(path)).select("c_custkey", "field", "content")


@query("A32 E22 B16", """
SELECT 'fb_' || strftime(DATE '2024-01-01' + CAST(user_id AS INT), '%m%d%Y') || '.log' AS filename, strftime(DATE '2024-01-01' + CAST(user_id AS INT), '%Y-%m-%d') AS date, count(*) AS seen,
count(CASE WHEN event_type = 'error' THEN 1 END) AS failed FROM events GROUP BY user_id""")
def log_summary_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """A log file of every user, of which the last summary counts, written, read and pivoted; the date is that of the file's name."""
    path = shared_folder(spark, "logs")
    sums = table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("seen"), F.count_if(F.col("event_type") == "error").alias("failed"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("user_id").cast("int"))
    failed = F.when(F.col("failed") > 0, F.concat(F.lit(", 'failed': "), F.col("failed").cast("string"))).otherwise("")
    log = F.concat(F.lit("2020-01-01 start\nRUN SUMMARY: {'seen': 0, 'failed': 99}\nRUN SUMMARY: {'seen': "), F.col("seen").cast("string"), failed, F.lit("}\nend"))
    sums.select(F.concat(F.lit("fb_"), F.date_format(day, "MMddyyyy"), F.lit(".log")).alias("filename"), log.alias("text")).write.parquet(path)
    each = papers.run_logs(spark.read.parquet(path)).select("filename", "date", F.explode("counters").alias("c", "v"))
    return each.groupBy("filename", "date").pivot("c", ["seen", "failed"]).agg(F.max("v")).na.fill(0)


@query("A32 E22", """
SELECT event_type, count(CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) < 50 THEN 1 END) AS low, count(CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) >= 50 THEN 1 END) AS high FROM events GROUP BY 1""")
def json_counters(spark: SparkSession, sf: str) -> DataFrame:
    k = F.from_json("props", "map<string,bigint>")["k"]
    return table(spark, sf, "events").groupBy("event_type").agg(F.count_if(k < 50).alias("low"), F.count_if(k >= 50).alias("high"))


@query("A30", """
WITH e AS (SELECT p_partkey AS seq, 'G' || p_partkey % 50 AS gene, p_brand || '-' || p_partkey % 50 AS symbol, p_name AS fullname, p_type || '|' || p_name AS symbols, CASE WHEN p_size > 25 THEN p_brand || '|x' || p_size END AS fulls FROM part),
n AS (SELECT seq, gene, unnest(string_split(coalesce(fulls, ''), '|')) AS name, 0 AS priority FROM e UNION ALL SELECT seq, gene, fullname, 1 FROM e UNION ALL SELECT seq, gene, unnest(string_split(symbols, '|')), 2 FROM e UNION ALL SELECT seq, gene, symbol, 3 FROM e)
SELECT name, gene FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY priority DESC, seq DESC, gene) AS r FROM n WHERE name <> '') WHERE r = 1""")
def gene_synonyms(spark: SparkSession, sf: str) -> DataFrame:
    """Names of fifty genes, among which the names, types and brands of all parts are synonyms that meet."""
    gene = (F.col("p_partkey") % 50).cast("string")
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("seq"), F.concat(F.lit("G"), gene).alias("gene"), F.concat("p_brand", F.lit("-"), gene).alias("symbol"), F.col("p_name").alias("fullname"),
        F.concat_ws("|", "p_type", "p_name").alias("symbol_synonyms"), F.when(F.col("p_size") > 25, F.concat("p_brand", F.lit("|x"), F.col("p_size").cast("string"))).alias("fullname_synonyms"),
    )
    return papers.gene_synonyms(rows)


@query("A31 D07", """
SELECT CAST(o_custkey AS VARCHAR) AS "PMID", max('PMC' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0')) AS "PMCID" FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 GROUP BY 1""")
def pmcids(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV file of pairs of ids, of which some lack either, written and read back."""
    path, key = shared_folder(spark, "pmcids"), F.col("o_orderkey")
    pmid = F.when(key % 3 == 0, "").otherwise(F.col("o_custkey").cast("string"))
    pmcid = F.when(key % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("PMC"), F.lpad(key.cast("string"), 9, "0")))
    table(spark, sf, "orders").select(pmid.alias("PMID"), pmcid.alias("PMCID"), F.lit("x,y").alias("Journal")).write.csv(path, header=True)
    return papers.paired_ids(spark.read.schema("PMID STRING, PMCID STRING, Journal STRING").csv(path, header=True))


@query("A26 B08", """
SELECT DISTINCT 'AGRKB:' || user_id AS curie, CASE WHEN event_type = 'purchase' THEN 'positive' ELSE 'negative' END AS classification FROM events WHERE event_type <> 'error'""")
def dataset_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A data set's CSV file with spaces, capitals and empty categories, read into entries."""
    path, kind = shared_folder(spark, "dataset"), F.col("event_type")
    category = F.when(kind == "purchase", " Positive").when(kind == "error", " ").otherwise("NEGATIVE ")
    table(spark, sf, "events").select(F.concat(F.lit("AGRKB:"), F.col("user_id").cast("string"), F.lit(" ")).alias("curie"), category.alias("classification")).write.csv(path, header=True)
    return papers.dataset_entries(spark.read.schema("curie STRING, classification STRING").csv(path, header=True))


@query("A27", """
WITH n AS (SELECT 'AGRKB:' || c_custkey AS curie, min(c_name) AS name FROM customer WHERE c_custkey % 4 <> 0 GROUP BY 1)
SELECT i.curie, coalesce(n.name, i.curie) AS name FROM (SELECT DISTINCT 'AGRKB:' || o_custkey AS curie FROM orders) i LEFT JOIN n USING (curie)""")
def named_ids_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV file of ids to classify, with the names that a map has for some."""
    path, curie = shared_folder(spark, "ids"), lambda c: F.concat(F.lit("AGRKB:"), F.col(c).cast("string"))
    table(spark, sf, "orders").select(curie("o_custkey").alias("curie")).write.csv(path, header=True)
    ids = papers.curies(spark.read.schema("curie STRING").csv(path, header=True), line="curie").distinct()
    return papers.with_names(ids, table(spark, sf, "customer").where("c_custkey % 4 <> 0").select(curie("c_custkey").alias("curie"), F.col("c_name").alias("name")))


@query("A33", "SELECT doc_id, 'prod/reference/documents/' || substr(md5(text), 1, 1) || '/' || substr(md5(text), 2, 1) || '/' || substr(md5(text), 3, 1) || '/' || substr(md5(text), 4, 1) || '/' || md5(text) || '.gz' AS path FROM documents")
def object_paths(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.object_path(F.md5("text"), "prod").alias("path"))


@query("A22 C07 C08", r"""
SELECT name, max(curie) AS curie FROM (SELECT p_brand AS name, 'P:' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS curie FROM part WHERE p_size > 5 UNION ALL SELECT CAST(p_size AS VARCHAR), 'S' FROM part) WHERE NOT regexp_matches(name, '^\d+$') GROUP BY 1""")
def curated_scan(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    curie = F.concat(F.lit("P:"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"))
    rows = part.where("p_size > 5").select(F.col("p_brand").alias("name"), curie.alias("curie")).unionByName(part.select(F.col("p_size").cast("string").alias("name"), F.lit("S").alias("curie")))
    return rows.where(~F.col("name").rlike(r"^\d+$")).groupBy("name").agg(F.max_by("curie", "curie").alias("curie"))


@query("A36 B11", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ' | ' ORDER BY o_orderpriority) AS entities FROM orders GROUP BY 1")
def tsv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    sets = table(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("names"))
    path = shared_folder(spark, "tsv")
    sinks.write_tsv(sinks.test_lines(sets, "o_custkey", "names"), path)
    return spark.read.schema("o_custkey BIGINT, entities STRING").csv(path, sep="\t", header=True)


@query("B17", "SELECT lang, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1")
def json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "json")
    table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).write.json(path)
    return spark.read.schema("lang STRING, n BIGINT, first BIGINT").json(path)


@query("B13", "SELECT vec_id, " + ", ".join(f"round(embedding[{i + 1}]::DOUBLE, 6) AS d{i}" for i in range(64)) + " FROM embeddings")
def wide_vectors(spark: SparkSession, sf: str) -> DataFrame:
    wide = sinks.wide_vectors(table(spark, sf, "embeddings"), ["vec_id"], "embedding", 64)
    return wide.select("vec_id", *[F.round(F.col(f"d{i}").cast("double"), 6).alias(f"d{i}") for i in range(64)])


@query("B10 B18 C13", """
WITH l AS (SELECT event_id, strftime(ts, '%y%m%d') || chr(9) || chr(9) || substr('AGRKB:' || CAST(user_id AS VARCHAR), 6) || chr(9) || CASE WHEN event_id % 2 = 0 THEN 'gene' ELSE 'UNKNOWN_FLAG_ATP:1' END || ':' ||
CASE WHEN value IS NULL THEN 'UNKNOWN_LEVEL_NONE' WHEN value / 100 = 0 THEN 'neg' WHEN value / 100 < 0.667 THEN 'low' WHEN value / 100 < 0.833 THEN 'medium' ELSE 'high' END || chr(9) || CASE WHEN event_id % 2 = 0 THEN 'cam' ELSE 'UNKNOWN_ATP_ATP:1' END AS value FROM events)
SELECT CASE WHEN event_id < 250 THEN 0 ELSE 1 END AS part, value FROM l""")
def export_lines(spark: SparkSession, sf: str) -> DataFrame:
    return exported(spark, sf)


def exported(spark: SparkSession, sf: str) -> DataFrame:
    topic = F.when(F.col("event_id") % 2 == 0, "ATP:0000005").otherwise("ATP:1")
    events = table(spark, sf, "events")
    line = sinks.export_line(F.col("ts"), F.concat(F.lit("AGRKB:"), F.col("user_id").cast("string")), topic, levels.export_level(F.col("value") / 100))
    lines = events.select("event_id", line.alias("value"))
    return sinks.on_top(lines.where("event_id < 250"), lines.where("event_id >= 250"))


@query("B01 B06", "SELECT min(event_id) AS event_id, user_id, event_type FROM events GROUP BY 2, 3")
def tag_table_appends(spark: SparkSession, sf: str) -> DataFrame:
    path, keys = shared_folder(spark, "tag-table"), ["user_id", "event_type"]
    tags = table(spark, sf, "events").groupBy(*keys).agg(F.min("event_id").alias("event_id")).select("event_id", *keys)
    sinks.append_tags(spark, path, tags.where("user_id < 70"), keys)
    sinks.append_tags(spark, path, tags, keys)  # repeats what is there, which changes nothing
    return spark.read.parquet(path)


CASES = [
    (1, "We used qIs51 as a GFP marker.", "qIs51", "transgene marker (qIs51)"), (2, "The qIs51 strain was studied.", "qIs51", None),
    (3, "pzEx12 expressing GFP", "pzEx12", "extrachromosomal array (pzEx12)"), (4, "inserted into the ttTi5605 site", "ttTi5605", "transposon insertion site (ttTi5605)"),
    (5, "unc-119(ed3) animals", "ed3", "background marker (ed3)"), (6, "dpy-10(e128) worms", "e128", "genetic marker (e128)"),
    (7, "rol-6(su1006) was injected", "su1006", "co-injection marker (su1006)"), (8, "the su1006 cuticle is helical", "su1006", None),
    (9, "him-8(e1489) males", "e1489", "male-production marker (e1489)"), (10, "ok99 was a positive control", "ok99", "control allele (ok99)"),
    (11, "hT2 balancer", "hT2", "balancer chromosome name (hT2)"), (12, "hT2[bli-4(e937)]", "e937", "balancer allele (e937)"),
    (13, "auxin-inducible degron with tir1", "tir1", "degron system reagent (tir1)"), (14, "budding yeast strain Δyfh1", "yfh1", "yeast gene or strain (yfh1)"),
    (15, "this is identical to tm12", "tm12", "reference-only mention (tm12)"), (16, "histone H3 tails", "h3", "histone or protein name (h3)"),
    (17, "at time t1 we", "t1", "measurement (t1)"), (18, "gfp was seen", "gfp", "reagent name (gfp)"),
    (19, "Figure 1 b2 and Fig. 3 b2", "b2", "figure or panel label (b2)"), (20, "see Fig. S12 now", "s12", "supplementary reference (s12)"),
    (21, "the daf-2(e1370) mutant", "e1370", None), (22, "ieSi64 with the AID system", "ieSi64", "degron system transgene (ieSi64)"),
]


# Every document with one of the sentences between its own text, by its number.
PLANTED = "c AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {c!r}, {'NULL' if r is None else repr(r)})" for i, _, c, r in CASES) + f") t(id, name, reason)), p AS (SELECT doc_id, name, reason FROM documents JOIN c ON doc_id % {len(CASES)} + 1 = id)"


def planted(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, text, names: all documents with a planted sentence and the name to judge in it."""
    case = F.element_at(F.array(*[F.struct(F.lit(s).alias("s"), F.lit(c).alias("c")) for _, s, c, _ in CASES]), (F.col("doc_id") % len(CASES) + 1).cast("int"))
    whole = F.concat_ws("\n", "text", case["s"], "text")
    return table(spark, sf, "documents").select("doc_id", whole.alias("text"), F.array(case["c"]).alias("names"))


@query("R1 R2 R3 R4a R4b R4c R4d R5 R6a R6b R7 R8 R9 R10 R11 R12 R13 R14 G26 G28", f"WITH {PLANTED} SELECT * FROM p")
def allele_rules(spark: SparkSession, sf: str) -> DataFrame:
    return alleles.judged(planted(spark, sf), "text", "names", "doc_id")


@query("E18 G28", f"WITH {PLANTED} SELECT trim(split_part(reason, '(', 1)) AS category, count(*) AS n FROM p WHERE reason IS NOT NULL GROUP BY 1")
def allele_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return alleles.reasons(alleles.judged(planted(spark, sf), "text", "names", "doc_id"))


@query("G27 G29", """
SELECT doc_id, unnest(['e1370', 'ok' || (1000 + doc_id), 'ed3', 'a' || (100 + doc_id % 7)]) AS name, unnest([NULL, NULL, 'background marker (ed3)', NULL]) AS reason FROM documents""")
def allele_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Planted names: found with a dot, rescued, a marker, found twice, one too short, and one that no list has."""
    docs, n = table(spark, sf, "documents"), F.col("doc_id")
    own, further = F.concat(F.lit("ok"), (n + 1000).cast("string")), F.concat(F.lit("a"), (n % 7 + 100).cast("string"))
    sentence = F.concat(F.lit("daf-2(e1370) and "), own, F.lit(" in unc-119(ed3), Figure 1 b2, or the "), further, F.lit(" and zz9999 alleles."))
    rows = docs.select("doc_id", F.concat_ws("\n", "text", sentence).alias("text"), F.array(F.lit("e1370."), F.lit("b2"), further, F.lit("e1370")).alias("found"))
    listed = docs.select(F.explode(F.array(F.lit("e1370"), F.lit("ed3"), F.lit("b2"), own, further)).alias("name"))
    return alleles.judged(rows, "text", "found", "doc_id", listed, chain=True)


@query("G28")
def allele_candidates_judged(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").withColumn("names", text.allele_tokens(F.col("text")))
    return alleles.judged(docs, "text", "names", "doc_id").withColumnRenamed("name", "candidate")


GENES = {f"gene{i}": f"G{i // 2}" for i in range(20)}


@query("E19 C14 C15", """
WITH m AS (SELECT doc_id, 'G' || CAST(g // 2 AS VARCHAR) AS gene, n FROM (SELECT doc_id, doc_id % 20 AS g, doc_id % 3 + 1 AS n FROM documents UNION ALL SELECT doc_id, doc_id // 20 % 20, 1 FROM documents) WHERE g <> 7),
s AS (SELECT doc_id, gene, sum(n) AS n FROM m GROUP BY 1, 2) SELECT doc_id, gene, CAST(n AS BIGINT) AS n, round(n / sum(n) OVER (PARTITION BY doc_id), 9) AS of_genes FROM s""")
def italic_gene_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as XML with italic genes in its front, its first section and the others; one gene is an exception."""
    docs, n = table(spark, sf, "documents"), F.col("doc_id")
    italic = lambda g: F.concat(F.lit("<italic>gene"), g.cast("string"), F.lit("</italic> "))
    one, other = italic(n % 20), italic(F.floor(n / 20) % 20)
    escaped = F.regexp_replace(F.coalesce("text", F.lit("")), "[<>&]", " ")
    sections = F.concat(F.lit("<sec><p>"), one, F.lit("first</p></sec><sec><p>"), F.repeat(one, (n % 3 + 1).cast("int")), F.lit("</p><p>"), escaped, F.lit("</p></sec><sec><p>"), other, F.lit("<italic>none</italic></p></sec>"))
    xml = F.concat(F.lit("<article><front>"), other, F.lit("</front><body>"), sections, F.lit("</body><back>"), one, F.lit("</back></article>"))
    found = papers.gene_mentions(docs.select("doc_id", xml.alias("xml")), GENES, ["gene7"], "doc_id")
    summed = found.groupBy("doc_id", "gene").agg(F.sum("n").alias("n"), F.sum("of_genes").alias("of_genes"))
    return summed.select("doc_id", "gene", "n", F.round("of_genes", 9).alias("of_genes"))


@query("streaming A02", "SELECT DISTINCT event_id, user_id, event_type FROM events WHERE event_type = 'purchase'")
def streamed_jobs(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    stream = streams.job_stream(spark, sf, schema, "events.parquet").where("event_type = 'purchase'")
    return streams.drained(streams.distinct_jobs(stream, ["event_id"]).select("event_id", "user_id", "event_type"))


@query("streaming E01", "SELECT start, event_type, count(*) AS n FROM (SELECT *, date_trunc('day', ts) AS start FROM events) WHERE start <= (SELECT date_trunc('day', max(ts) - INTERVAL 1 HOUR) - INTERVAL 1 DAY FROM events) GROUP BY 1, 2")
def streamed_day_counts(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    return streams.drained(streams.windowed_counts(streams.job_stream(spark, sf, schema, "events.parquet"), "event_type"))


@query("streaming B01", "SELECT user_id, event_type FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2")
def streamed_appends(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    target = shared_folder(spark, "appended")
    stream = streams.job_stream(spark, sf, schema, "events.parquet").where("event_type in ('click', 'view')").select("user_id", "event_type")
    streams.drain(stream.dropDuplicates(["user_id", "event_type"]), target, ["user_id", "event_type"])
    return spark.read.parquet(target)
