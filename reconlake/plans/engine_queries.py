"""Queries over whole tables for the engine's operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reconlake.functions import text as T
from reconlake.operators import aggregate as A
from reconlake.operators import extract as X
from reconlake.operators import linkage as L
from reconlake.operators import ordering as O
from reconlake.operators import overrides as U
from reconlake.operators import reconcile as R
from reconlake.plans import sqltext as Q
from reconlake.session import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str = ""):
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


MAX_NAMES = 10_000  # names of a reference list that become one pattern or literal; more are refused


def registry_names(spark: SparkSession, sf_dir: str) -> list[str]:
    """The product names of the reference list, a list of bounded length."""
    rows = load(spark, sf_dir, "product_registry").select("product").distinct().limit(MAX_NAMES + 1).collect()
    if len(rows) > MAX_NAMES:
        raise ValueError(f"the list has more than {MAX_NAMES} names; use name_mentions")
    return sorted(r[0] for r in rows)


#: one pattern of all names of the list, the longest first; signs with a meaning in patterns are escaped
_REGISTRY_SQL = """names AS (SELECT '(' || string_agg(regexp_replace(product, '([.+*?()|/^$])', '\\\\\\1', 'g'), '|' ORDER BY length(product) DESC, product) || ')' AS alt FROM product_registry)"""
_LINES_SQL = """
lines AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS line_no, line
  FROM (SELECT doc_id, unnest(generate_series(1, len(ls))) AS p, trim(unnest(ls), ' ') AS line
        FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
  WHERE line <> '')
"""

# ---------------------------------------------------------------- extraction and windows


@query(f"""WITH {_LINES_SQL},
near AS (SELECT doc_id, line_no, line, string_agg(line, ' ') OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near FROM lines),
hits AS (SELECT doc_id, line_no, near, unnest(regexp_extract_all(line, '([0-9][0-9,]*)円', 1)) AS a,
         unnest(generate_series(1, len(regexp_extract_all(line, '([0-9][0-9,]*)円', 1)))) AS hit_no FROM near)
SELECT doc_id, line_no, CAST(hit_no AS BIGINT) AS hit_no, CAST(replace(a, ',', '') AS BIGINT) AS amount,
       contains(near, '税') AS tax_near, CAST(length(near) AS BIGINT) AS near_len FROM hits""")
def line_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts by line with facts of the five lines around."""
    hits = X.line_amounts(load(spark, sf_dir, "documents"), "doc_id", "text")
    return hits.select("doc_id", "line_no", "hit_no", "amount", F.contains("near", F.lit("税")).alias("tax_near"), F.length("near").cast("bigint").alias("near_len"))


@query("""SELECT doc_id, raw, CAST(floor(CAST(raw AS DOUBLE) * 10000) AS BIGINT) AS cut, CAST(round(CAST(raw AS DOUBLE) * 10000) AS BIGINT) AS rounded
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '([0-9]+(?:\\.[0-9]+)?)万円', 1)) AS raw FROM documents)""")
def amounts_cut_and_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.ten_thousand_amounts(load(spark, sf_dir, "documents"), "doc_id", "text")


@query("""WITH r AS (SELECT doc_id, unnest(regexp_extract_all(text, '([0-9][0-9,]*)円?[~〜～から]+([0-9][0-9,]*)円', 1)) AS x,
  unnest(regexp_extract_all(text, '([0-9][0-9,]*)円?[~〜～から]+([0-9][0-9,]*)円', 2)) AS y FROM documents),
n AS (SELECT doc_id, CAST(replace(x, ',', '') AS BIGINT) AS x, CAST(replace(y, ',', '') AS BIGINT) AS y FROM r),
p AS (SELECT doc_id, CAST(replace(unnest(regexp_extract_all(regexp_replace(text, '([0-9][0-9,]*)円?[~〜～から]+([0-9][0-9,]*)円', ' ', 'g'), '([0-9][0-9,]*)円', 1)), ',', '') AS BIGINT) AS a FROM documents)
SELECT doc_id, 'range' AS kind, least(x, y) AS low, greatest(x, y) AS high FROM n UNION ALL SELECT doc_id, 'point', a, a FROM p""")
def amounts_and_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.amounts_and_ranges(load(spark, sf_dir, "documents"), "doc_id", "text")


@query("""SELECT doc_id, regexp_extract(text, '(?s)(.{0,40}(?:費用|The fee).{0,60})', 1) AS excerpt FROM documents
WHERE regexp_extract(text, '(?s)(.{0,40}(?:費用|The fee).{0,60})', 1) <> ''""")
def char_window_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents")
    return d.select("doc_id", X.snippet(F.col("text"), "費用|The fee", 40, 60).alias("excerpt")).where("excerpt != ''")


@query(f"""WITH {_REGISTRY_SQL}
SELECT doc_id, array_to_string(list_sort(list_distinct(h)), '|') AS hits, CAST(len(list_distinct(h)) AS BIGINT) AS n_hits
FROM (SELECT doc_id, regexp_extract_all(text, alt, 1) AS h FROM documents, names) WHERE len(h) > 0""")
def dictionary_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = X.dictionary_hits(load(spark, sf_dir, "documents"), "doc_id", "text", registry_names(spark, sf_dir))
    return h.select("doc_id", F.array_join("hits", "|").alias("hits"), F.size("hits").cast("bigint").alias("n_hits"))


@query(f"""WITH {_REGISTRY_SQL}
SELECT doc_id FROM documents, names WHERE regexp_matches(text, '(?s)(?:遠心|is drawn and prepared).{{0,60}}' || alt || '|' || alt || '.{{0,60}}(?:遠心|is drawn and prepared)')""")
def context_gated_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.gated_hits(load(spark, sf_dir, "documents"), "doc_id", "text", registry_names(spark, sf_dir), "遠心|is drawn and prepared")


@query(f"""WITH {_LINES_SQL}
SELECT doc_id, line_no, coalesce(lag(line) OVER w, '') AS before_line, coalesce(lead(line) OVER w, '') AS after_line FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)""")
def neighbor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.lines(load(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "line_no", F.col("before").alias("before_line"), F.col("after").alias("after_line"))


@query("""SELECT plan_id, CASE WHEN len(l) > 0 THEN array_to_string(l, '/') ELSE 'other' END AS labels, CASE WHEN contains(treatment, '多血小板') THEN 'prp' WHEN contains(treatment, '細胞') THEN 'cell' ELSE 'other' END AS first_label
FROM (SELECT plan_id, treatment, list_filter([CASE WHEN contains(treatment, '多血小板') THEN 'prp' END, CASE WHEN contains(treatment, '細胞') THEN 'cell' END, CASE WHEN contains(treatment, '関節') THEN 'joint' END, CASE WHEN contains(treatment, '注射') THEN 'injection' END], lambda x: x IS NOT NULL) AS l FROM treatment_plan WHERE treatment IS NOT NULL)""")
def multi_label_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [("prp", "多血小板"), ("cell", "細胞"), ("joint", "関節"), ("injection", "注射")]
    t = load(spark, sf_dir, "treatment_plan").where("treatment is not null")
    return t.select("plan_id", X.labels(F.col("treatment"), rules, "other").alias("labels"), X.first_label(F.col("treatment"), rules[:2], "other").alias("first_label"))


@query("""SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_signup FROM events""")
def nearest_preceding_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return L.preceding(e, "user_id", ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), "last_signup").select("event_id", "user_id", "last_signup")


@query("""SELECT user_id, grp, CAST(count(*) AS BIGINT) AS n, round(sum(value), 2) AS total FROM (
SELECT user_id, value, CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS grp FROM events) GROUP BY user_id, grp""")
def running_group_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = L.running_group(load(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "view", "grp")
    return e.groupBy("user_id", "grp").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("""WITH p AS (SELECT event_id, user_id, event_type, last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS click_value FROM events)
SELECT event_id, user_id, click_value FROM p WHERE event_type = 'purchase'""")
def as_of_preceding_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    p = L.preceding(e, "user_id", ["ts", "event_id"], F.when(F.col("event_type") == "click", F.col("value")), "click_value")
    return p.where("event_type = 'purchase'").select("event_id", "user_id", "click_value")


@query("""WITH s AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS island FROM events),
g AS (SELECT user_id, count(*) AS n FROM s WHERE event_type = 'error' GROUP BY user_id, island)
SELECT user_id, CAST(max(n) AS BIGINT) AS longest FROM g GROUP BY user_id""")
def longest_error_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps and islands: the longest run of errors of each user."""
    e = load(spark, sf_dir, "events")
    a, b = Window.partitionBy("user_id").orderBy("ts", "event_id"), Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    s = e.withColumn("island", F.row_number().over(a) - F.row_number().over(b)).where("event_type = 'error'")
    return s.groupBy("user_id", "island").agg(F.count("*").alias("n")).groupBy("user_id").agg(F.max("n").alias("longest"))


# ---------------------------------------------------------------- names, addresses, codes

_STEM = Q.strip_legal(Q.compact("n"))


@query(f"""SELECT plan_id, {Q.compact('n')} AS compact_name, {_STEM} AS stem, concat_ws('|', coalesce(prefecture, ''), coalesce({_STEM}, '')) AS facility_key
FROM (SELECT plan_id, prefecture, {Q.nfkc('facility')} AS n FROM treatment_plan)""")
def normalized_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load(spark, sf_dir, "treatment_plan")
    c = T.compact(F.col("facility"))
    return t.select("plan_id", c.alias("compact_name"), T.strip_legal(c).alias("stem"), T.facility_key(F.col("prefecture"), F.col("facility")).alias("facility_key"))


@query(f"""SELECT facility_id, {Q.address_key('a', 'prefecture')} AS address_key, {Q.digits_key('a')} AS digits_key FROM (SELECT facility_id, prefecture, {Q.nfkc('address')} AS a FROM nonqueue_facility)""")
def address_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("address")
    return load(spark, sf_dir, "nonqueue_facility").select("facility_id", T.address_key(a, F.col("prefecture")).alias("address_key"), T.address_digits_key(a).alias("digits_key"))


@query("""SELECT prefecture, region, CAST(count(*) AS BIGINT) AS n FROM (SELECT prefecture, CASE """ + " ".join(
    f"WHEN prefecture IN ({', '.join(repr(p) for p in names.split())}) THEN '{r}'" for r, names in T.REGIONS.items()
) + " ELSE '' END AS region FROM (SELECT CASE " + " ".join(f"WHEN contains(address, '{p}') THEN '{p}'" for p in T.PREFECTURES) + " END AS prefecture FROM locator)) GROUP BY prefecture, region")
def prefecture_and_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "locator").select(T.prefecture_of(F.col("address")).alias("prefecture"))
    return p.withColumn("region", T.region_of(F.col("prefecture"))).groupBy("prefecture", "region").agg(F.count("*").alias("n"))


@query("""SELECT facility_id, 'F' || upper(substr(sha1(concat_ws('|', coalesce(prefecture, ''), coalesce(facility, ''), coalesce(address, ''))), 1, 10)) AS key FROM nonqueue_facility""")
def surrogate_key_sha1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "nonqueue_facility").select("facility_id", T.surrogate_key("F", F.col("prefecture"), F.col("facility"), F.col("address")).alias("key"))


@query("""SELECT row_id, regexp_extract(document_url, '/download/([^/]+)/', 1) AS code, regexp_extract(document_url, '^[a-z]+://([^/:?#]+)', 1) AS host FROM price_stage WHERE document_url IS NOT NULL""")
def url_code_and_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "price_stage").where("document_url is not null")
    return p.select("row_id", T.code_of_url(F.col("document_url")).alias("code"), T.host_of_url(F.col("document_url")).alias("host"))


@query("""SELECT doc_id, md5(trim(regexp_replace(text, '[ \\t\\n\\r\\f　 ]+', ' ', 'g'))) AS text_md5 FROM documents""")
def collapsed_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", F.md5(T.collapse_space(F.col("text")).cast("binary")).alias("text_md5"))


@query("""SELECT doc_id, CAST(length(regexp_replace(regexp_replace(text, '([0-9])[ \\t]+([0-9,])', '\\1\\2', 'g'), '([0-9])[ \\t]+([0-9,])', '\\1\\2', 'g')) AS BIGINT) AS n_chars_repaired FROM documents""")
def repaired_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", F.length(T.repair_digits(F.col("text"))).cast("bigint").alias("n_chars_repaired"))


def _without(c: str, words: tuple[str, ...]) -> str:
    for w in words:
        c = f"replace({c}, '{w}', '')"
    return c


@query(f"""WITH n AS (SELECT facility_id, {Q.nfkc('facility')} AS n FROM nonqueue_facility), c AS (SELECT facility_id, n, {Q.compact('n')} AS whole, {_STEM} AS short FROM n),
p AS (SELECT facility_id, {_without(Q.strip_legal(Q.compact("part")), T.GENERIC_WORDS)} AS a, 5 AS least FROM (SELECT facility_id, unnest(regexp_split_to_array({Q.strip_legal('n')}, '[・&＆/]')) AS part FROM n)),
u AS (SELECT facility_id, whole AS a, 5 AS least FROM c UNION ALL SELECT facility_id, short, 5 FROM c UNION ALL SELECT facility_id, {_without('short', T.GENERIC_WORDS)}, 6 FROM c UNION ALL SELECT * FROM p)
SELECT facility_id, CAST(row_number() OVER (PARTITION BY facility_id ORDER BY length(a) DESC, a) - 1 AS BIGINT) AS place, a AS alias FROM (SELECT DISTINCT facility_id, a FROM u WHERE length(a) >= least)""")
def name_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "nonqueue_facility").select("facility_id", F.posexplode(T.aliases(F.col("facility"), bare=6, separators="[・&＆/]")).alias("place", "alias"))
    return a.withColumn("place", F.col("place").cast("bigint"))


@query("""SELECT plan_id, u.l.label AS label, u.l.url AS url FROM (SELECT plan_id, unnest(document_urls_source) AS l FROM treatment_plan) u""")
def exploded_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load(spark, sf_dir, "treatment_plan").select("plan_id", F.explode("document_urls_source").alias("l"))
    return t.select("plan_id", "l.label", "l.url")


@query("""SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total_k FROM events GROUP BY event_type""")
def json_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return load(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total_k"))


# ---------------------------------------------------------------- joins


def _keys(df: DataFrame, name: str, place: str) -> DataFrame:
    strict = T.compact(F.col(name))
    return df.withColumn("strict", strict).withColumn("loose", T.strip_legal(strict)).withColumn("place", F.col(place))


_LOCATED = f"""l AS (SELECT facility_id, {Q.compact('n')} AS strict, {_STEM} AS loose, prefecture AS place FROM (SELECT facility_id, prefecture, {Q.nfkc('facility')} AS n FROM nonqueue_facility)),
r AS (SELECT locator_id, {Q.compact('n')} AS strict, {_STEM} AS loose, {Q.prefecture('address')} AS place FROM (SELECT locator_id, address, {Q.nfkc('name')} AS n FROM locator))"""
_CASCADE_SQL = f"""WITH {_LOCATED},
us AS (SELECT strict, min(locator_id) AS locator_id FROM r WHERE strict <> '' GROUP BY strict HAVING count(*) = 1), ul AS (SELECT loose, min(locator_id) AS locator_id FROM r WHERE length(loose) >= 5 GROUP BY loose HAVING count(*) = 1),
h AS (SELECT facility_id, locator_id, 1 AS level FROM l JOIN r USING (strict, place) WHERE strict <> '' AND place <> '' UNION SELECT facility_id, locator_id, 2 FROM l JOIN r USING (loose, place) WHERE loose <> '' AND place <> ''
UNION SELECT facility_id, locator_id, 3 FROM l JOIN us USING (strict) UNION SELECT facility_id, locator_id, 4 FROM l JOIN ul USING (loose))
SELECT facility_id, locator_id, CAST(level AS BIGINT) AS level FROM (SELECT *, min(level) OVER (PARTITION BY facility_id) AS f FROM h) WHERE level = f"""


@query(_CASCADE_SQL)
def cascade_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = _keys(load(spark, sf_dir, "nonqueue_facility"), "facility", "prefecture")
    right = load(spark, sf_dir, "locator").withColumn("pref", T.prefecture_of(F.col("address")))
    out = L.cascade(left, _keys(right, "name", "pref"), "facility_id", "locator_id", "strict", "loose", "place")
    return out.withColumn("level", F.col("level").cast("bigint"))


@query(f"""WITH {_LOCATED}
SELECT facility_id, locator_id, CASE WHEN l.loose = r.loose THEN 'equal' ELSE 'contained' END AS kind FROM l JOIN r ON l.place = r.place AND least(length(l.loose), length(r.loose)) >= 5 AND (contains(l.loose, r.loose) OR contains(r.loose, l.loose))""")
def containment_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = load(spark, sf_dir, "nonqueue_facility").select("facility_id", T.strip_legal(T.compact(F.col("facility"))).alias("k"), F.col("prefecture").alias("place"))
    right = load(spark, sf_dir, "locator").select("locator_id", T.strip_legal(T.compact(F.col("name"))).alias("k"), T.prefecture_of(F.col("address")).alias("place"))
    return L.containment(left, right, "facility_id", "locator_id", "k", "place")


def _named_places(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Facilities and source records by stripped name, with the prefecture they state."""
    key = lambda n, k: T.strip_legal(T.compact(F.col(n))).alias(k)
    stated = F.when(F.col("prefecture") != "", F.col("prefecture")).alias("place")
    left = load(spark, sf_dir, "nonqueue_facility").select("facility_id", key("facility", "lk"), stated)
    right = load(spark, sf_dir, "locator_match").select("match_id", key("source_facility_name", "rk"), T.prefecture_of(F.col("source_address")).alias("place"))
    return left, right


@query()
def fuzzy_blocked_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By edit distance of characters in the prefecture, unknown ones meeting all; SQL at hand counts bytes, so a brute-force test stands in."""
    return L.best_in_place(*_named_places(spark, sf_dir), "facility_id", "match_id", "edit", 0.62)


@query()
def sequence_ratio_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above by Ratcliff-Obershelp similarity, which SQL lacks."""
    return L.best_in_place(*_named_places(spark, sf_dir), "facility_id", "match_id", "ratio", 0.62)


@query("""SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY o_custkey""")
def semi_and_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    back = load(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    kept = o.join(c, o.o_custkey == c.c_custkey, "left_semi").join(back, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
    return kept.groupBy("o_custkey").agg(F.count("*").alias("n"))


@query("""SELECT plan_id, facility_id FROM treatment_plan WHERE plan_id NOT IN (SELECT plan_id FROM price_stage WHERE lane = 'A') ORDER BY plan_id LIMIT 24""")
def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next 24 plans without a staged row in lane A; the limit is the feature."""
    done = load(spark, sf_dir, "price_stage").where("lane = 'A'").select("plan_id")
    return load(spark, sf_dir, "treatment_plan").join(done, "plan_id", "left_anti").select("plan_id", "facility_id").orderBy("plan_id").limit(24)


@query("""SELECT r.manufacturer_share_group AS maker, CAST(count(*) AS BIGINT) AS n FROM (SELECT trim(unnest(regexp_split_to_array(products, '[|/]'))) AS product FROM price_stage) p JOIN product_registry r USING (product) GROUP BY 1""")
def dimension_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "price_stage").select(F.explode(F.split("products", "[|/]")).alias("product")).select(F.trim("product").alias("product"))
    r = load(spark, sf_dir, "product_registry").select("product", F.col("manufacturer_share_group").alias("maker"))
    return p.groupBy("product").agg(F.count("*").alias("n")).join(r, "product").groupBy("maker").agg(F.sum("n").cast("bigint").alias("n"))


# ---------------------------------------------------------------- aggregation


@query("""SELECT facility_id, coalesce(array_to_string(list_sort(list_distinct(list(makers) FILTER (makers <> ''))), '|'), '') AS makers, coalesce(array_to_string(list_sort(list_distinct(list(treatment_class) FILTER (treatment_class <> ''))), '|'), '') AS classes,
arg_max(status, row_id) FILTER (status IS NOT NULL) AS last_status FROM price_stage GROUP BY facility_id""")
def evidence_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.evidence_union(load(spark, sf_dir, "price_stage"), ["facility_id"], {"makers": "makers", "classes": "treatment_class"}, {"last_status": "status"}, "row_id")


@query("""SELECT facility_id, arg_min(facility, row_id) FILTER (facility <> '') AS facility, arg_min(prefecture, row_id) FILTER (prefecture <> '') AS prefecture FROM price_stage GROUP BY facility_id""")
def first_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.first_nonempty(load(spark, sf_dir, "price_stage"), ["facility_id"], ["facility", "prefecture"], "row_id")


@query("""WITH p AS (SELECT DISTINCT facility_id, makers FROM price_stage WHERE makers IS NOT NULL), n AS (SELECT makers, CAST(count(*) AS BIGINT) AS n FROM p GROUP BY makers)
SELECT makers, n, round(CAST(n AS DOUBLE) / (SELECT sum(n) FROM n), 4) AS share FROM n""")
def market_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.share(load(spark, sf_dir, "price_stage"), "facility_id", "makers")


@query("""SELECT value, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(list_filter(list_transform(regexp_split_to_array(makers, '[|/]'), lambda x: trim(x)), lambda x: x <> '')) AS value FROM price_stage) GROUP BY value""")
def multi_value_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.filter(F.transform(F.split("makers", "[|/]"), lambda p: F.trim(p)), lambda p: p != "")
    return A.counter(load(spark, sf_dir, "price_stage").select(parts.alias("v")), "v")


@query("""SELECT lane, prefecture, category, CAST(count(*) AS BIGINT) AS n FROM price_stage GROUP BY GROUPING SETS ((lane), (prefecture), (category), ())""")
def grouping_sets_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    load(spark, sf_dir, "price_stage").createOrReplaceTempView("_price_stage_profile")
    return spark.sql("SELECT lane, prefecture, category, count(*) AS n FROM _price_stage_profile GROUP BY GROUPING SETS ((lane), (prefecture), (category), ())")


@query("""SELECT lane, CAST(count_if(status = 'AUTO') AS BIGINT) AS n_auto, CAST(count_if(status = 'QC') AS BIGINT) AS n_qc, CAST(count_if(status = 'FAIL') AS BIGINT) AS n_fail, CAST(count(DISTINCT facility_id) AS BIGINT) AS n_facilities,
CASE WHEN count(*) > 0 THEN round(CAST(count(amount) AS DOUBLE) / count(*), 4) ELSE 0 END AS stated FROM price_stage GROUP BY lane""")
def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "price_stage").groupBy("lane")
    of = lambda v: F.count_if(F.col("status") == v)
    return s.agg(of("AUTO").alias("n_auto"), of("QC").alias("n_qc"), of("FAIL").alias("n_fail"), F.countDistinct("facility_id").alias("n_facilities"), A.ratio(F.count("amount"), F.count("*")).alias("stated"))


@query(f"""SELECT place, arg_min(facility, (length(facility), facility)) AS representative, CAST(count(*) - 1 AS BIGINT) AS further, array_to_string(list_sort(list_distinct(list(facility))), '|') AS spellings
FROM (SELECT facility, {Q.digits_key('a')} AS place FROM (SELECT facility, {Q.nfkc('address')} AS a FROM nonqueue_facility WHERE facility IS NOT NULL AND address IS NOT NULL)) GROUP BY place""")
def collapsed_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = load(spark, sf_dir, "nonqueue_facility").where("facility is not null and address is not null")
    return A.collapse(f.withColumn("place", T.address_digits_key(F.col("address"))), ["place"], "facility")


@query("""SELECT plan_id, CAST(count(DISTINCT makers) AS BIGINT) AS n_values, array_to_string(list_sort(list_distinct(list(makers))), '|') AS "values" FROM price_stage WHERE makers IS NOT NULL GROUP BY plan_id HAVING count(DISTINCT makers) > 1""")
def conflicting_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.conflicts(load(spark, sf_dir, "price_stage"), "plan_id", "makers")


@query("""WITH g AS (SELECT l_partkey, l_suppkey, max(l_quantity) AS m, count(*) AS n FROM lineitem GROUP BY 1, 2),
b AS (SELECT l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY m DESC, n DESC, l_suppkey) AS r FROM g) WHERE r = 1)
SELECT l_partkey, l_suppkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem JOIN b USING (l_partkey, l_suppkey)""")
def best_group_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = A.best_group(load(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey", "l_quantity")
    return b.select("l_partkey", "l_suppkey", "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"))


# ---------------------------------------------------------------- sort, top-k, distinct


@query("""SELECT o_custkey, o_orderkey, CAST(place AS BIGINT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders) WHERE place <= 3""")
def top_k_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = O.top_per_group(load(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)
    return t.select("o_custkey", "o_orderkey", F.col("place").cast("bigint").alias("place"))


@query("""WITH b AS (SELECT l_suppkey, l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY q DESC, l_partkey) AS r FROM b) WHERE r = 1)
SELECT CAST(row_number() OVER (ORDER BY q DESC, l_suppkey) AS BIGINT) AS rank, l_suppkey, l_partkey, q FROM f ORDER BY q DESC, l_suppkey LIMIT 10""")
def next_batch_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best pair of each supplier, ranked; the ten first are the feature."""
    b = load(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"))
    f = O.top_per_group(b, ["l_suppkey"], [F.desc("q"), F.col("l_partkey")]).orderBy(F.desc("q"), "l_suppkey").limit(10)
    rank = F.row_number().over(Window.orderBy(F.desc("q"), "l_suppkey")).cast("bigint")  # ten rows
    return f.select(rank.alias("rank"), "l_suppkey", "l_partkey", "q")


@query("""SELECT plan_id, row_id, lane FROM (SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY CASE lane WHEN 'A' THEN 1 WHEN 'B' THEN 2 ELSE 3 END, row_id) AS r FROM price_stage) WHERE r = 1""")
def source_preference_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pref = F.when(F.col("lane") == "A", 1).when(F.col("lane") == "B", 2).otherwise(3)
    return U.latest(load(spark, sf_dir, "price_stage"), ["plan_id"], [pref, F.col("row_id")]).select("plan_id", "row_id", "lane")


@query("""SELECT DISTINCT facility_id, prefecture, treatment_class FROM price_stage""")
def exact_row_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "price_stage").select("facility_id", "prefecture", "treatment_class").dropDuplicates()


@query("""SELECT amount, row_id, products FROM (SELECT *, max(CASE WHEN products IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY plan_id, amount) AS labelled, row_number() OVER (PARTITION BY plan_id, amount ORDER BY CASE WHEN products IS NOT NULL THEN 0 ELSE 1 END, row_id) AS r FROM price_stage WHERE amount IS NOT NULL) WHERE r = 1 AND (products IS NOT NULL OR labelled = 0)""")
def quality_ranked_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "price_stage").where("amount is not null")
    return O.top_per_group(p, ["plan_id", "amount"], [F.when(F.col("products").isNotNull(), 0).otherwise(1), F.col("row_id")]).select("amount", "row_id", "products")


# ---------------------------------------------------------------- sets, reconciliation, staging


@query("""SELECT 'A' AS lane, CAST(count(*) AS BIGINT) AS n, min(o_orderkey) AS first_key FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'B', CAST(count(*) AS BIGINT), min(o_orderkey) FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'C', CAST(count(*) AS BIGINT), min(o_orderkey) FROM orders WHERE o_orderstatus = 'P'""")
def union_of_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    lanes = [o.where(F.col("o_orderstatus") == s).withColumn("lane", F.lit(n)) for n, s in (("A", "F"), ("B", "O"), ("C", "P"))]
    return lanes[0].unionByName(lanes[1]).unionByName(lanes[2]).groupBy("lane").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


@query("""(SELECT name, 'missing' AS side FROM (SELECT facility AS name FROM nonqueue_facility EXCEPT SELECT name FROM locator)) UNION ALL (SELECT name, 'extra' FROM (SELECT name FROM locator EXCEPT SELECT facility FROM nonqueue_facility))""")
def missing_and_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = load(spark, sf_dir, "nonqueue_facility").select(F.col("facility").alias("name"))
    return R.missing_and_extra(f, load(spark, sf_dir, "locator"), ["name"])


_FIELDS = ("facility_id", "prefecture", "facility", "category", "treatment_class")


@query("""WITH s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY row_id) AS r FROM price_stage) WHERE r = 1)
""" + " UNION ALL ".join(f"SELECT plan_id, '{f}' AS field, t.{f} AS left_value, s.{f} AS right_value FROM treatment_plan t JOIN s USING (plan_id) WHERE t.{f} IS DISTINCT FROM s.{f}" for f in _FIELDS))
def identity_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = U.latest(load(spark, sf_dir, "price_stage"), ["plan_id"], [F.col("row_id")])
    return R.mismatches(load(spark, sf_dir, "treatment_plan"), first, "plan_id", list(_FIELDS))


@query("""WITH a AS (SELECT plan_id, amount, tax, unit FROM price_stage), b AS (SELECT DISTINCT plan_id, amount, tax, unit FROM price_stage)
SELECT plan_id, amount, tax, unit, CAST(count(*) - 1 AS BIGINT) AS surplus FROM a GROUP BY ALL HAVING count(*) > 1""")
def multiset_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "price_stage").select("plan_id", "amount", "tax", "unit")
    return R.multiset_difference(a, a.distinct())


@query("""WITH t AS (SELECT DISTINCT plan_id, tax FROM price_stage WHERE tax IS NOT NULL) SELECT a.tax AS tag_a, b.tax AS tag_b, CAST(count(*) AS BIGINT) AS n FROM t a JOIN t b ON a.plan_id = b.plan_id AND a.tax < b.tax GROUP BY 1, 2""")
def partition_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.overlaps(load(spark, sf_dir, "price_stage").where("tax is not null"), "plan_id", "tax")


@query("""SELECT plan_id, CAST(count(*) AS BIGINT) AS n, min(row_id) AS survivor FROM price_stage GROUP BY plan_id HAVING count(*) > 1""")
def duplicate_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.duplicates(load(spark, sf_dir, "price_stage"), "plan_id", "row_id")


@query("""SELECT t.plan_id, p.row_id, p.amount, CASE WHEN p.row_id IS NULL THEN 'placeholder' ELSE 'staged' END AS kind FROM treatment_plan t LEFT JOIN price_stage p USING (plan_id)""")
def staged_with_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = R.with_placeholders(load(spark, sf_dir, "treatment_plan").select("plan_id"), load(spark, sf_dir, "price_stage").select("plan_id", "row_id", "amount"), "plan_id")
    return s.withColumn("kind", F.when(F.col("row_id").isNull(), "placeholder").otherwise("staged"))


@query("""SELECT batch_no, CAST(count(*) AS BIGINT) AS n, min(row_id) AS first_row, max(row_id) AS last_row FROM (SELECT row_id, CAST(floor((row_number() OVER (ORDER BY plan_id, row_id) - 1) / 150) AS BIGINT) AS batch_no FROM price_stage) GROUP BY batch_no""")
def bounded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = O.batches(load(spark, sf_dir, "price_stage").select("plan_id", "row_id"), ["plan_id", "row_id"], 150)
    return b.groupBy("batch_no").agg(F.count("*").alias("n"), F.min("row_id").alias("first_row"), F.max("row_id").alias("last_row"))


# ---------------------------------------------------------------- overrides and incremental work


@query("""WITH a AS (SELECT o_orderkey, o_orderstatus || '-1' AS status FROM orders WHERE o_orderkey % 7 = 0), b AS (SELECT o_orderkey, o_orderstatus || '-2' AS status FROM orders WHERE o_orderkey % 21 = 0)
SELECT o.o_orderkey, CASE WHEN b.o_orderkey IS NOT NULL THEN b.status WHEN a.o_orderkey IS NOT NULL THEN a.status ELSE o.o_orderstatus END AS status, CASE WHEN b.o_orderkey IS NOT NULL THEN 'verified' WHEN a.o_orderkey IS NOT NULL THEN 'official' ELSE 'base' END AS status_source
FROM orders o LEFT JOIN a USING (o_orderkey) LEFT JOIN b USING (o_orderkey)""")
def override_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    layer = lambda m, s: o.where(F.col("o_orderkey") % m == 0).withColumn("status", F.concat("status", F.lit(s)))
    return U.precedence(o, "o_orderkey", "status", [("official", layer(7, "-1")), ("verified", layer(21, "-2"))])


@query("""SELECT plan_id, queue_index, row_id, loaded_at FROM (SELECT *, row_number() OVER (PARTITION BY plan_id, queue_index, checked_at ORDER BY loaded_at DESC, row_id DESC) AS r FROM price_stage) WHERE r = 1""")
def latest_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows delivered again: the latest delivery of each."""
    p = load(spark, sf_dir, "price_stage")
    return U.latest(p, ["plan_id", "queue_index", "checked_at"], [F.desc("loaded_at"), F.desc("row_id")]).select("plan_id", "queue_index", "row_id", "loaded_at")


@query("""WITH new AS (SELECT c_custkey, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_custkey % 5 = 0 UNION ALL SELECT c_custkey + 1000000, c_acctbal FROM customer WHERE c_custkey % 50 = 0)
SELECT c_custkey, round(c_acctbal, 2) AS c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM new) UNION ALL SELECT c_custkey, round(c_acctbal, 2) FROM new""")
def upsert_reprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    new = c.where("c_custkey % 5 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1).unionByName(c.where("c_custkey % 50 = 0").withColumn("c_custkey", F.col("c_custkey") + 1000000))
    return U.upsert(c, new, "c_custkey").withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("""SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name"))
    return U.insert_if_absent(load(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), c, "s_suppkey")


@query("""SELECT row_id, CASE WHEN amount IS NULL THEN 'fetch' WHEN tax IS NULL OR tax = '不明' THEN 'review' ELSE 'done' END AS route FROM price_stage""")
def routed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [("fetch", F.col("amount").isNull()), ("review", F.col("tax").isNull() | (F.col("tax") == "不明"))]
    return U.route(load(spark, sf_dir, "price_stage"), rules, "done").select("row_id", "route")


# ---------------------------------------------------------------- sampling, sharding, dashboard


@query("""SELECT shard, CAST(count(*) AS BIGINT) AS n, min(c_custkey) AS first_key FROM (SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_name, c_custkey) - 1) % 8 AS BIGINT) AS shard FROM customer) GROUP BY shard""")
def modulo_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = O.modulo_shard(load(spark, sf_dir, "customer").select("c_name", "c_custkey"), ["c_name", "c_custkey"], 8)
    return s.groupBy("shard").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first_key"))


@query("""SELECT prefecture, facility_id, CAST(turn AS BIGINT) AS turn FROM (SELECT *, row_number() OVER (PARTITION BY prefecture ORDER BY facility_id) AS turn FROM nonqueue_facility WHERE prefecture IS NOT NULL) ORDER BY turn, prefecture LIMIT 50""")
def stratified_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of 50 in turns over the prefectures; the limit is the feature."""
    f = load(spark, sf_dir, "nonqueue_facility").where("prefecture is not null").select("prefecture", "facility_id")
    return O.round_robin(f, "prefecture", ["facility_id"], 50).select("prefecture", "facility_id", F.col("turn").cast("bigint").alias("turn"))


@query("""SELECT CAST(count(*) AS BIGINT) AS processed, CAST(count_if(event_type <> 'error') AS BIGINT) AS ok, CAST(count_if(event_type = 'error') AS BIGINT) AS failed, CAST(round(100.0 * count_if(event_type <> 'error') / count(*)) AS BIGINT) AS percent FROM events""")
def dashboard_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    good = F.count_if(F.col("event_type") != "error")
    return e.agg(F.count("*").alias("processed"), good.alias("ok"), F.count_if(F.col("event_type") == "error").alias("failed"), F.round(100.0 * good / F.count("*")).cast("bigint").alias("percent"))


@query("""SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 30""")
def recent_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 30 latest; the limit is the feature."""
    return load(spark, sf_dir, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(30).select("event_id", "user_id", "event_type")


@query("""SELECT plan_id, coalesce(array_to_string(list_slice(list_transform(list_sort(list_distinct(list(amount) FILTER (amount IS NOT NULL))), lambda x: CAST(x AS VARCHAR)), 1, 4), ', '), '') || CASE WHEN count(DISTINCT amount) > 4 THEN ' +' || CAST(count(DISTINCT amount) - 4 AS VARCHAR) ELSE '' END AS shown FROM price_stage GROUP BY plan_id""")
def first_amounts_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four least amounts of each plan and how many more there are; no more than four are held for a plan."""
    p = load(spark, sf_dir, "price_stage").select("plan_id", "amount").distinct()
    n = p.groupBy("plan_id").agg(F.count("amount").alias("n"))
    few = O.top_per_group(p.where("amount is not null"), ["plan_id"], [F.col("amount")], 4).groupBy("plan_id").agg(F.array_sort(F.collect_list("amount")).alias("a"))
    more = F.when(F.col("n") > 4, F.concat(F.lit(" +"), (F.col("n") - 4).cast("string"))).otherwise("")
    shown = F.coalesce(F.array_join(F.col("a").cast("array<string>"), ", "), F.lit(""))
    return n.join(few, "plan_id", "left").select("plan_id", F.concat(shown, more).alias("shown"))


# ---------------------------------------------------------------- names and tokens inside documents


@query("""SELECT DISTINCT doc_id, facility FROM documents JOIN (SELECT DISTINCT facility FROM treatment_plan WHERE length(facility) >= 4) ON contains(text, facility)""")
def document_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities of the plans that each document names."""
    return X.name_mentions(load(spark, sf_dir, "documents"), "doc_id", "text", load(spark, sf_dir, "treatment_plan"), "facility")


@query()
def nearest_product_before_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each amount of a document with the product named at most 100 characters before it."""
    return X.nearest_before(load(spark, sf_dir, "documents"), "doc_id", "text", r"[0-9][0-9,]*円", X.alternation(registry_names(spark, sf_dir)), 100)


@query("""WITH f AS (SELECT facility_id, min(row_id) AS first_row FROM price_stage GROUP BY facility_id ORDER BY first_row LIMIT 20)
SELECT facility_id, row_id FROM price_stage JOIN f USING (facility_id)""")
def first_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the first 20 facilities in order of appearance; the bound is the feature."""
    p = load(spark, sf_dir, "price_stage")
    f = p.groupBy("facility_id").agg(F.min("row_id").alias("first_row")).orderBy("first_row").limit(20)
    return p.join(F.broadcast(f.select("facility_id")), "facility_id").select("facility_id", "row_id")


@query("""SELECT row_id, array_to_string(list_distinct(list_transform(v, lambda x: coalesce(m[x], x))), '|') AS canon FROM (SELECT row_id, list_transform(regexp_split_to_array(products, '[|/]'), lambda x: trim(x)) AS v FROM price_stage WHERE products IS NOT NULL),
(SELECT map(list(product), list(canonical_product)) AS m FROM product_registry)""".replace("list_distinct(", "list_sort(list_distinct(").replace("x))), '|')", "x)))), '|')"))
def canonical_unique_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical names of products between bars or slashes by exact lookup, each once."""
    registry = load(spark, sf_dir, "product_registry").select("product", "canonical_product").limit(MAX_NAMES + 1).collect()
    if len(registry) > MAX_NAMES:
        raise ValueError(f"the list has more than {MAX_NAMES} entries; use a join")
    m = F.map_from_arrays(F.array(*[F.lit(r[0]) for r in registry]), F.array(*[F.lit(r[1]) for r in registry]))
    v = F.transform(F.split("products", "[|/]"), lambda x: F.trim(x))
    p = load(spark, sf_dir, "price_stage").where("products is not null")
    return p.select("row_id", F.array_join(F.array_sort(T.canonical_unique(v, m)), "|").alias("canon"))


@query("""SELECT CASE WHEN t.plan_id IS NULL THEN 'unknown' WHEN p.n IS NULL THEN 'queued' WHEN p.open > 0 THEN 'processing' ELSE 'complete' END AS phase, CAST(count(*) AS BIGINT) AS n FROM treatment_plan t LEFT JOIN (SELECT plan_id, count(*) AS n, count_if(amount IS NULL) AS open FROM price_stage GROUP BY plan_id) p USING (plan_id) GROUP BY 1""")
def work_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the work on the plans is: queued, processing, complete."""
    done = load(spark, sf_dir, "price_stage").groupBy("plan_id").agg(F.count("*").alias("n"), F.count_if(F.col("amount").isNull()).alias("open"))
    phase = F.when(F.col("n").isNull(), "queued").when(F.col("open") > 0, "processing").otherwise("complete")
    return load(spark, sf_dir, "treatment_plan").select("plan_id").join(done, "plan_id", "left").groupBy(phase.alias("phase")).agg(F.count("*").alias("n"))
