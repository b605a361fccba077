"""Queries about texts, dictionaries and the taxonomy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import antibody, species, text
from inkwell.operators import dictionary, scoring, taxonomy
from inkwell.plans.catalog import query
from inkwell.sources.storage import stored
from inkwell.sources.tables import table

MARK = "chr(1)"
SENTENCES = rf"string_split(regexp_replace(text, '([.!?])\s+', '\1' || {MARK}, 'g'), {MARK})"
FIRST, SECOND = ("that", "with", "from", "this"), ("there", "which", "was", "be")
CLOSE = r"[\s.;:,''\")\]}>?]"


@query("G05 md-sentences", f"SELECT doc_id, len({SENTENCES}) AS n_sentences FROM documents")
def sentence_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.size(text.sentences(F.col("text"))).cast("long").alias("n_sentences"))


HITS = ", ".join(
    f"CASE WHEN regexp_matches(low, '^[^\\n]*{a}\\s[^\\n]*{b}{CLOSE}') OR regexp_matches(low, '^[^\\n]*{b}\\s[^\\n]*{a}{CLOSE}') THEN '{a} {b}' END" for a in FIRST for b in SECOND
)


@query("G15 G17 E21 C06", f"""
WITH s AS (SELECT doc_id, ' ' || lower(unnest({SENTENCES})) || ' ' AS low FROM documents),
h AS (SELECT DISTINCT doc_id, unnest([{HITS}]) AS m FROM s)
SELECT d.doc_id, n.note, n.note IS NULL AS negated FROM documents d
LEFT JOIN (SELECT doc_id, string_agg(m, ', ' ORDER BY m) AS note FROM h WHERE m IS NOT NULL GROUP BY 1) n USING (doc_id)""")
def antibody_style_rules(spark: SparkSession, sf: str) -> DataFrame:
    return antibody_notes(table(spark, sf, "documents"))


def antibody_notes(docs: DataFrame) -> DataFrame:
    each = docs.select("doc_id", F.explode(text.sentences(F.col("text"))).alias("s"))
    found = antibody.matches(each, "s", [], FIRST, SECOND, name="m").where(~F.col("m").startswith("anti-"))
    notes = found.groupBy("doc_id").agg(antibody.note(F.collect_set("m")).alias("note"))
    return docs.select("doc_id").join(notes, "doc_id", "left").select("doc_id", "note", F.col("note").isNull().alias("negated"))


ANTIBODY_CASES = [
    ("We used anti-PDR-1 serum.", "anti-PDR-1"), ("We used anti-pdr-1 serum.", None), ("We used anti-PDI serum.", None), ("An anti-C. elegans serum.", "anti-C. elegans"), ("Stained by anti-MSP.", "anti-MSP"),
    ("We raised an antibody.", "raised antibody"), ("Antibodies in this preparation ", "preparation antibodies"), ("Stained with MH46.", "MH46"), ("Then a-SP56, too", "a-SP56"), ("A commercial antibody was bought.", None),
    ("We used anti–PDR-1 serum.", "anti-PDR-1"), ("Raised antibody, anti-UNC-54.", "anti-UNC-54, raised antibody"),
]


@query("G16 G18 D15", "SELECT doc_id, note FROM documents JOIN (VALUES " + ", ".join(f"({i}, {'NULL' if n is None else repr(n)})" for i, (_, n) in enumerate(ANTIBODY_CASES)) + f") c(id, note) ON doc_id % {len(ANTIBODY_CASES)} = id")
def antibody_rule_cases(spark: SparkSession, sf: str) -> DataFrame:
    """The sentences of every document, with a planted one before them."""
    docs = table(spark, sf, "documents")
    planted = F.element_at(F.array(*[F.lit(c) for c, _ in ANTIBODY_CASES]), (F.col("doc_id") % len(ANTIBODY_CASES) + 1).cast("int"))
    each = docs.select("doc_id", F.explode(F.concat(F.array(planted), text.sentences(F.coalesce("text", F.lit(""))))).alias("s"))
    found = antibody.matches(each, "s", ["pdr-1", "pdi", "unc-54"]).groupBy("doc_id").agg(antibody.note(F.collect_set("match")).alias("note"))
    return docs.select("doc_id").join(found, "doc_id", "left")


@query("C12", f"""
SELECT doc_id, coalesce(nullif(list_aggregate(list_filter({SENTENCES}, lambda s: regexp_matches(s, '[0-9]')), 'string_agg', ' '), ''), text) AS kept FROM documents""")
def prefilter_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.prefiltered(F.col("text"), "[0-9]").alias("kept"))


RUNS = r"list_distinct(regexp_extract_all(text, '[A-Za-z0-9_.\-]+'))"


@query("G02", f"""
SELECT doc_id, array_to_string(list_sort(list_filter({RUNS}, lambda t: length(t) >= 2 AND regexp_matches(t, '[A-Za-z]') AND regexp_matches(t, '[0-9]'))), ' ') AS tokens
FROM documents WHERE len(list_filter({RUNS}, lambda t: length(t) >= 2 AND regexp_matches(t, '[A-Za-z]') AND regexp_matches(t, '[0-9]'))) > 0""")
def generic_tokens(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "documents").select("doc_id", text.generic_tokens(F.col("text")).alias("t")).where("size(t) > 0")
    return found.select("doc_id", F.array_join(F.array_sort("t"), " ").alias("tokens"))


@query("G03", f"""
SELECT doc_id, array_to_string(list_sort(list_filter({RUNS}, lambda t: length(t) >= 2 AND regexp_matches(t, '^[a-z]') AND regexp_matches(t, '[0-9]'))), ' ') AS tokens
FROM documents WHERE len(list_filter({RUNS}, lambda t: length(t) >= 2 AND regexp_matches(t, '^[a-z]') AND regexp_matches(t, '[0-9]'))) > 0""")
def allele_like_tokens(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "documents").select("doc_id", text.allele_tokens(F.col("text")).alias("t")).where("size(t) > 0")
    return found.select("doc_id", F.array_join(F.array_sort("t"), " ").alias("tokens"))


STRAINS = ["strain CB1370, wild", "the BA(x1)y line", "plain words 12 only", "of A-1_b."]


@query("G01", r"""
WITH t AS (SELECT doc_id, text || ' ' || ['strain CB1370, wild', 'the BA(x1)y line', 'plain words 12 only', 'of A-1_b.'][doc_id % 4 + 1] AS t FROM documents),
f AS (SELECT doc_id, list_distinct(regexp_extract_all(t, '[A-Za-z0-9](?:[A-Za-z0-9_-]|\([A-Za-z0-9]+\))*')) AS f FROM t)
SELECT doc_id, array_to_string(list_sort([x for x in f if regexp_matches(x, '[A-Za-z]') and regexp_matches(x, '[0-9]')]), ' ') AS tokens FROM f""")
def strain_tokens(spark: SparkSession, sf: str) -> DataFrame:
    own = F.element_at(F.array(*map(F.lit, STRAINS)), (F.col("doc_id") % 4 + 1).cast("int"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(F.array_sort(text.strain_tokens(F.concat_ws(" ", "text", own))), " ").alias("tokens"))


MINED = r"""list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(text, '[A-Za-z0-9_.\-]+'), lambda t: regexp_replace(t, '^[._\-]+|[._\-]+$', '', 'g')),
 lambda t: length(t) >= 2 AND regexp_matches(t, '[A-Za-z]') AND regexp_matches(t, '[0-9]') AND NOT regexp_matches(lower(t), '^(fig|sup|sub|sec|eq|lt|gt|amp)') AND NOT regexp_matches(lower(t), '^[ivxlcdm]+$'))))"""


@query("G06 C10", f"SELECT doc_id, array_to_string({MINED}, '. ') AS mined FROM documents WHERE len({MINED}) > 0")
def mined_entity_tokens(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "documents").select("doc_id", text.mined_tokens(F.col("text")).alias("t")).where("size(t) > 0")
    return found.select("doc_id", F.array_join("t", ". ").alias("mined"))


@query("G07 G08 A18", r"""
SELECT page_id, CASE WHEN t LIKE '%.' THEN t ELSE t || '.' END AS text FROM (SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(
 regexp_replace(html, '<[^<]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&nbsp;', ' '), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS t FROM pages)""")
def strip_markup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", text.closed_sentence(text.without_markup(F.col("html"))).alias("text"))


WORDS = r"unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"


@query("E10 E26", rf"""
SELECT doc_id, count(*) AS n_words, count(DISTINCT lower(w)) AS n_distinct FROM (SELECT doc_id, {WORDS} AS w FROM documents) GROUP BY 1""")
def bow_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    w = text.words(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.size(w).cast("long").alias("n_words"), F.size(F.array_distinct(F.transform(w, F.lower))).cast("long").alias("n_distinct")).where("n_words > 0")


NAMES = rf"""SELECT DISTINCT lower(regexp_replace(w, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')) AS token FROM (SELECT {WORDS} AS w FROM benchmark)"""
TOKENS = rf"""SELECT doc_id, lower(regexp_replace(w, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')) AS token FROM (SELECT doc_id, {WORDS} AS w FROM documents)"""


def curated_names(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark")
    return dictionary.tokens(items, "item_id", "text").select(F.lower("token").alias("name")).distinct()


@query("D13 E02 E03", f"WITH n AS ({NAMES}), t AS ({TOKENS}) SELECT doc_id, token, count(*) AS n FROM t JOIN n USING (token) WHERE token <> '' GROUP BY 1, 2 HAVING count(*) >= 2")
def dictionary_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.mentions(table(spark, sf, "documents"), curated_names(spark, sf)).where("n >= 2")


@query("E11 E12", f"""
WITH n AS ({NAMES}), t AS ({TOKENS}) SELECT token, count(DISTINCT doc_id) AS df, round(ln(((SELECT count(*) FROM documents) + 1) / (count(DISTINCT doc_id) + 1)) + 1, 9) AS idf
FROM t JOIN n USING (token) WHERE token <> '' GROUP BY 1""")
def document_frequency_idf(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_idf(spark, sf, curated_names(spark, sf))


def rounded_idf(spark: SparkSession, sf: str, names: DataFrame) -> DataFrame:
    docs = table(spark, sf, "documents")
    return dictionary.idf(dictionary.mentions(docs, names), docs.count()).withColumn("idf", F.round("idf", 9))


@query("E04 E05 C20 H15", f"""
WITH n AS ({NAMES}), t AS ({TOKENS}), c AS (SELECT doc_id, token, count(*) AS n FROM t JOIN n USING (token) WHERE token <> '' GROUP BY 1, 2),
s AS (SELECT doc_id, count(*) AS k FROM c GROUP BY 1), i AS (SELECT token, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) + 1 AS idf FROM c GROUP BY 1)
SELECT doc_id, token, n, round(n / k * idf, 9) AS tfidf FROM c JOIN s USING (doc_id) JOIN i USING (token) WHERE n >= 2 AND n / k * idf >= 0.5""")
def tfidf_gate(spark: SparkSession, sf: str) -> DataFrame:
    return gated(spark, sf, curated_names(spark, sf))


def gated(spark: SparkSession, sf: str, names: DataFrame) -> DataFrame:
    docs = table(spark, sf, "documents")
    # Written once: its sizes, frequencies and rows are each read.
    counts = stored(dictionary.mentions(docs, names), "mentions")
    passed = dictionary.tfidf_gate(counts, dictionary.idf(counts, docs.count()), 0.5, 2)
    return passed.withColumn("tfidf", F.round("tfidf", 9))


@query("H16")
def gene_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The most frequent curated name of every document, scored with its text by a model of the labelled documents."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labelled = docs.join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id")
    path = scoring.trained(labelled).save(spark)
    found = scoring.best_candidates(dictionary.mentions(docs, curated_names(spark, sf)), docs)
    return scoring.scored_by(found, path).select("doc_id", "symbol", "n", F.round("score", 6).alias("score"))


@query("D14 D12")
def dictionary_longest_match(spark: SparkSession, sf: str) -> DataFrame:
    # Of every item its whole text and, as a short name, its first words.
    forms = F.explode(F.array("text", F.regexp_extract("text", r"^(\S+ \S+ \S+)", 1)))
    return dictionary.longest_matches(table(spark, sf, "documents"), table(spark, sf, "benchmark").select(forms.alias("name")))


@query("D01 D02 D03 G22", """
WITH names AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE upper(p_name) END AS name FROM part),
cur AS (SELECT p_name AS name, max('PART:' || CAST(p_partkey AS VARCHAR)) AS curie FROM part WHERE p_size < 40 GROUP BY 1),
up AS (SELECT upper(name) AS u, max(curie) AS curie FROM cur GROUP BY 1)
SELECT n.p_partkey, n.name, coalesce(c.curie, u.curie) AS curie FROM names n LEFT JOIN cur c ON n.name = c.name LEFT JOIN up u ON upper(n.name) = u.u WHERE coalesce(c.curie, u.curie) IS NOT NULL""")
def name_to_curie_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return resolved_parts(spark, sf)


def resolved_parts(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    curated = part.where("p_size < 40").select(F.col("p_name").alias("name"), F.concat(F.lit("PART:"), F.col("p_partkey").cast("string")).alias("curie"))
    names = part.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.upper("p_name")).alias("name"))
    return dictionary.resolve(names, curated)


@query("D03", """
SELECT c.curie, coalesce(n.name, c.curie) AS name FROM (SELECT DISTINCT 'B:' || p_brand AS curie FROM part) c
LEFT JOIN (SELECT 'B:' || p_brand AS curie, max(p_name) AS name FROM part WHERE p_size > 45 GROUP BY 1) n USING (curie)""")
def curie_display_names(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(F.concat(F.lit("B:"), "p_brand").alias("curie"), F.col("p_name").alias("name"), "p_size")
    return dictionary.display_names(part.select("curie").distinct(), part.where("p_size > 45"))


@query("D04", "SELECT c_custkey, coalesce(CASE WHEN n_nationkey % 3 = 0 THEN n_name END, 'default') AS taxon FROM customer JOIN nation ON c_nationkey = n_nationkey")
def taxon_default_join(spark: SparkSession, sf: str) -> DataFrame:
    taxa = table(spark, sf, "nation").where("n_nationkey % 3 = 0").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, sf, "customer").join(taxa, "c_nationkey", "left").select("c_custkey", F.coalesce("n_name", F.lit("default")).alias("taxon"))


@query("F14", """
WITH t AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Za-z]{3,}')) AS name FROM documents)
SELECT doc_id, count(*) AS n FROM t WHERE NOT EXISTS (SELECT 1 FROM t x WHERE x.doc_id = t.doc_id AND upper(x.name) = t.name AND x.name <> upper(x.name)) GROUP BY 1""")
def no_shouting_twins(spark: SparkSession, sf: str) -> DataFrame:
    return unshouted(table(spark, sf, "documents"))


def unshouted(docs: DataFrame) -> DataFrame:
    names = docs.select("doc_id", F.explode(text.distinct_runs(F.col("text"), "[A-Za-z]{3,}")).alias("name"))
    return dictionary.no_shouting_twins(names, "doc_id", "name").groupBy("doc_id").agg(F.count("*").alias("n"))


@query("G30", r"""
WITH t AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]{3,}'))) AS token FROM benchmark) SELECT token, row_number() OVER (ORDER BY token) AS id FROM t""")
def token_id_encoding(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark").select(F.explode(F.transform(text.distinct_runs(F.col("text"), "[A-Za-z]{3,}"), F.lower)).alias("token"))
    return dictionary.token_ids(items)


COMMON = ", ".join(f"({a!r}, {c!r})" for a, c in species.COMMON_NAMES.items())


@query("G10 G13 G14 G11", f"""
WITH n AS (SELECT DISTINCT upper(p_name[1]) || p_name[2:] || CASE WHEN p_partkey % 3 = 0 THEN ' ' || lower(p_type) ELSE '' END AS c FROM part), w AS (SELECT c, string_split(c, ' ') AS w FROM n),
a AS (SELECT c, unnest([c] || CASE WHEN len(w) > 1 THEN [c[1] || '. ' || array_to_string(w[2:], ' '), c[1] || '.' || w[2], c[1] || ' ' || array_to_string(w[2:], ' '), c[1] || '.' || array_to_string(w[2:], ' ')] ELSE [] END) AS alias FROM w)
SELECT alias, coalesce(max(common), max(c)) AS canonical FROM (SELECT lower(alias) AS alias, c, NULL AS common FROM a UNION ALL SELECT alias, NULL, c FROM (VALUES {COMMON}) t(alias, c)) GROUP BY 1""")
def species_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """The names of all parts as binomials, some of three words, with their aliases and the common names."""
    part = table(spark, sf, "part")
    kind = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" "), F.lower("p_type"))).otherwise("")
    names = part.select(F.concat(F.upper(F.substring("p_name", 1, 1)), F.substring("p_name", 2, 100), kind).alias("name")).distinct()
    return species.alias_table(names)


@query("G04 G09 G12 G13", """
SELECT doc_id, 'Paper ' || doc_id || ' on Caenorhabditis elegans and Mus musculus, ' || ['in Danio rerio', 'no ratio', 'Schizosaccharomyces pombe: 5 fi'][doc_id % 3 + 1] AS text, 'Caenorhabditis elegans and' AS named FROM documents""")
def species_normalised(spark: SparkSession, sf: str) -> DataFrame:
    """A sentence about every document with abbreviations, markup, odd spaces, ligatures and common names."""
    other = F.element_at(F.array(*map(F.lit, ("in zebrafish", "no\u00a0ratio", "fission-yeast: 5 \ufb01"))), (F.col("doc_id") % 3 + 1).cast("int"))
    own = F.concat(F.lit("Paper\u2009"), F.col("doc_id").cast("string"), F.lit(" on C.</hi> elegans and \n Mouse, "), other)
    replaced = species.replace_aliases(table(spark, sf, "documents").select("doc_id", own.alias("text")), "text", species.COMMON_NAMES)
    whole = replaced.withColumn("text", species.expand_abbreviations(F.col("text")))
    return whole.withColumn("named", F.get(text.distinct_runs(F.col("text"), text.SPECIES_NAME), F.lit(0)))


@query("G19 G20 G21 G23 G24 G25", """
SELECT event_id, 'AGRKB_' || event_id AS file, 'AGRKB:' || event_id AS curie, CAST(user_id AS VARCHAR) AS taxon, event_type || ',b' || user_id AS names, 'big ' || event_type || ' world' AS words, event_type || 'ing word' || event_id AS pieces,
substr(sha1('["' || event_type || '", "x' || user_id || '"]'), 1, 16) AS key FROM events""")
def small_string_functions(spark: SparkSession, sf: str) -> DataFrame:
    n, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    joined = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    kind, curie = F.col("event_type"), joined("AGRKB:", n)
    pieces = text.merged_pieces(F.array(kind, F.lit("##ing"), F.lit("word"), joined("##", n)))
    return table(spark, sf, "events").select(
        "event_id", text.file_name(curie).alias("file"), text.curie_of(text.file_name(curie)).alias("curie"), text.taxon_id(joined("NCBITaxon:", user)).alias("taxon"),
        F.array_join(text.without_trailing_dots(F.array(joined(kind, ".."), kind, joined("b", user, "."), F.lit("..."))), ",").alias("names"), text.without_stop_words(joined("The Big the ", F.upper(kind), " World the"), ["the", "The"]).alias("words"),
        F.array_join(pieces, " ").alias("pieces"), text.cache_key(F.array(joined("x", user), kind, joined("x", user))).alias("key"),
    )


EDGES = """SELECT 'W' AS parent, 'R' || CAST(r_regionkey AS VARCHAR) AS child FROM region UNION SELECT 'R' || CAST(n_regionkey AS VARCHAR), 'N' || CAST(n_nationkey AS VARCHAR) FROM nation"""


def geography(spark: SparkSession, sf: str) -> DataFrame:
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    return taxonomy.merged_edges(region.select(F.lit("W").alias("parent"), name("R", "r_regionkey").alias("child")), nation.select(name("R", "n_regionkey").alias("parent"), name("N", "n_nationkey").alias("child")))


@query("E24 F15", f"SELECT child, string_agg(parent, ',' ORDER BY parent) AS parents FROM ({EDGES}) GROUP BY 1")
def reverse_index(spark: SparkSession, sf: str) -> DataFrame:
    return taxonomy.reverse_index(geography(spark, sf)).select("child", F.array_join("parents", ",").alias("parents"))


def detected(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey").distinct()
    nodes = F.array(F.concat(F.lit("N"), (F.col("o_custkey") % 25).cast("string")), F.concat(F.lit("R"), (F.col("o_custkey") % 5).cast("string")), F.when(F.col("o_custkey") % 2 == 0, "W").otherwise("R3"))
    return orders.select("o_custkey", F.explode(F.array_distinct(nodes)).alias("node"))


@query("F16", f"""
WITH RECURSIVE e AS ({EDGES}), up(node, ancestor) AS (SELECT child, parent FROM e UNION SELECT up.node, e.parent FROM up JOIN e ON up.ancestor = e.child),
f AS (SELECT DISTINCT k, node FROM (SELECT o_custkey AS k, unnest(['N' || CAST(o_custkey % 25 AS VARCHAR), 'R' || CAST(o_custkey % 5 AS VARCHAR), CASE WHEN o_custkey % 2 = 0 THEN 'W' ELSE 'R3' END]) AS node FROM orders))
SELECT k AS o_custkey, node FROM f WHERE NOT EXISTS (SELECT 1 FROM f x JOIN up ON x.node = up.node WHERE x.k = f.k AND up.ancestor = f.node)""")
def prune_to_most_specific(spark: SparkSession, sf: str) -> DataFrame:
    return taxonomy.most_specific(detected(spark, sf), taxonomy.ancestors(geography(spark, sf)), "o_custkey")


# A part's parents are its numbers over three and over five: lineages meet again above, and grow with the table.
LINEAGES = """SELECT DISTINCT CAST(p_partkey // d AS BIGINT) AS parent, CAST(p_partkey AS BIGINT) AS child FROM part, (VALUES (3), (5)) t(d) WHERE p_partkey > 0"""


def part_lineages(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").where("p_partkey > 0")
    above = F.explode(F.array(*[F.expr(f"p_partkey div {d}") for d in (3, 5)]))
    return taxonomy.merged_edges(parts.select(above.alias("parent"), F.col("p_partkey").cast("long").alias("child")))


@query("F16 F20 E24", f"""
WITH RECURSIVE e AS ({LINEAGES}), up(node, ancestor, depth) AS (SELECT child, parent, 1 FROM e UNION SELECT up.node, e.parent, up.depth + 1 FROM up JOIN e ON up.ancestor = e.child)
SELECT node, ancestor, min(depth) AS depth FROM up GROUP BY 1, 2""")
def shortest_lineages(spark: SparkSession, sf: str) -> DataFrame:
    return taxonomy.ancestors(part_lineages(spark, sf))


@query("F17 F19", f"""
WITH RECURSIVE e AS ({EDGES}), up(node, ancestor, depth) AS (SELECT child, parent, 1 FROM e UNION ALL SELECT up.node, e.parent, up.depth + 1 FROM up JOIN e ON up.ancestor = e.child),
l AS (SELECT node, ancestor, 1 AS source, depth FROM up UNION ALL SELECT 'N' || n_nationkey, 'R' || (n_nationkey + 1) % 5, 0, 1 + n_nationkey % 2 FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT 'N' || n_nationkey, 'W', 0, 2 - n_nationkey % 2 FROM nation WHERE n_nationkey % 3 = 0)
SELECT node, ancestor FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY source, depth, ancestor) AS rn FROM l WHERE ancestor IN ('W', 'R1', 'R2') AND node LIKE 'N%') WHERE rn = 1""")
def nearest_curated_ancestor(spark: SparkSession, sf: str) -> DataFrame:
    """A provider's parents, where it has any, over those of the closure; of each source the nearest that is curated."""
    closure = taxonomy.ancestors(geography(spark, sf)).withColumn("source", F.lit(1))
    n = F.col("n_nationkey")
    nation = table(spark, sf, "nation").where("n_nationkey % 3 = 0")
    node = F.concat(F.lit("N"), n.cast("string")).alias("node")
    first = nation.select(node, F.concat(F.lit("R"), ((n + 1) % 5).cast("string")).alias("ancestor"), (1 + n % 2).cast("int").alias("depth"), F.lit(0).alias("source"))
    other = nation.select(node, F.lit("W").alias("ancestor"), (2 - n % 2).cast("int").alias("depth"), F.lit(0).alias("source"))
    nodes = closure.where("node like 'N%'").select("node").distinct()
    curated = spark.createDataFrame([("W",), ("R1",), ("R2",)], "curie string")
    return taxonomy.nearest_curated(nodes, closure.unionByName(first).unionByName(other), curated)


@query("E19 F07", r"""
WITH t AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS w FROM documents), c AS (SELECT doc_id, w, count(*) AS n FROM t WHERE w IN ('the', 'of', 'and', 'der', 'die', 'de', 'la') GROUP BY 1, 2)
SELECT doc_id, w AS word, n, round(n / sum(n) OVER (PARTITION BY doc_id), 9) AS share FROM c""")
def share_of_mentions(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    w = table(spark, sf, "documents").select("doc_id", F.explode(text.words(F.col("text"))).alias("w")).select("doc_id", F.lower("w").alias("word"))
    counted = w.where(F.col("word").isin("the", "of", "and", "der", "die", "de", "la")).groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("doc_id")), 9))
