"""Cleaning, joins and aggregation queries (B, C, D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import wordpunct_tokens
from tessera.functions.units import to_litres
from tessera.operators import aggregate as A
from tessera.operators import clean as C
from tessera.operators import joins as J
from tessera.plans.common import PRODUCT_LOG_SQL, product_log
from tessera.plans.registry import query
from tessera.session import Tables

WP = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+)"


# ---------------------------------------------------------------- B: cleaning

@query("b1_parse_payload", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def b1_parse_payload(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return C.parse_payload(t.events.select("event_id", "event_type", "props"), "k long", "props")


@query("b2_label_first", "SELECT toxic, doc_id FROM labels")
def b2_label_first(spark, sf_dir):
    return C.label_first(Tables(spark, sf_dir).labels, "toxic", drop=["quality"])


_NULLY = """
SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS q,
       CASE WHEN l_returnflag = 'R' OR l_linestatus = 'O' THEN NULL ELSE l_discount END AS d,
       CASE WHEN l_returnflag IN ('R', 'A') THEN NULL ELSE l_tax END AS x FROM lineitem
"""


@query("b3_drop_empty", f"""
SELECT count(*) AS n_before, count(*) FILTER (WHERE q IS NOT NULL OR d IS NOT NULL OR x IS NOT NULL) AS n_after
FROM ({_NULLY})
""")
def b3_drop_empty(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    df = li.select(
        F.when(rf == "R", None).otherwise(F.col("l_quantity")).alias("q"),
        F.when((rf == "R") | (ls == "O"), None).otherwise(F.col("l_discount")).alias("d"),
        F.when(rf.isin("R", "A"), None).otherwise(F.col("l_tax")).alias("x"))
    return C.empty_row_report(df)


@query("b3_drop_empty_rows", f"SELECT * FROM ({_NULLY}) WHERE q IS NOT NULL OR d IS NOT NULL OR x IS NOT NULL")
def b3_drop_empty_rows(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    df = li.select(
        F.when(rf == "R", None).otherwise(F.col("l_quantity")).alias("q"),
        F.when((rf == "R") | (ls == "O"), None).otherwise(F.col("l_discount")).alias("d"),
        F.when(rf.isin("R", "A"), None).otherwise(F.col("l_tax")).alias("x"))
    return C.drop_empty(df)


@query("b4_parse_ts", """
WITH s AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a'
              WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%d/%m/%Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw FROM orders)
SELECT year(coalesce(try_strptime(raw, '%Y-%m-%d'), try_strptime(raw, '%d/%m/%Y'))) AS year,
       count(*) AS n FROM s GROUP BY 1
""")
def b4_parse_ts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    raw = (F.when(F.col("o_orderpriority") == "5-LOW", "n/a")
           .when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd/MM/yyyy"))
           .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    parsed = o.select(C.parse_ts(raw, ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("p"))
    return parsed.groupBy(F.year("p").cast("bigint").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query("b5_to_litres", """
WITH s AS (SELECT p_partkey, CASE WHEN p_size < 20 THEN CAST(p_size * 50 AS VARCHAR) || 'ml'
                                  ELSE CAST(p_size / 10.0 AS VARCHAR) || 'lt' END AS capacity FROM part)
SELECT p_partkey, capacity, round(CASE WHEN right(capacity, 2) = 'ml' THEN CAST(left(capacity, length(capacity) - 2) AS DOUBLE) / 1000
            ELSE CAST(left(capacity, length(capacity) - 2) AS DOUBLE) END, 6) AS litres FROM s
""")
def b5_to_litres(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    cap = (F.when(F.col("p_size") < 20, F.concat((F.col("p_size") * 50).cast("string"), F.lit("ml")))
           .otherwise(F.concat(F.format_number(F.col("p_size") / 10.0, 1), F.lit("lt"))))
    s = p.select("p_partkey", cap.alias("capacity"))
    return s.select("p_partkey", "capacity", F.round(to_litres("capacity"), 6).alias("litres"))


@query("b6_date_parts", """
SELECT o_orderkey, year(o_orderdate) AS o_orderdateYear, month(o_orderdate) AS o_orderdateMonth,
       weekofyear(o_orderdate) AS o_orderdateWeek, day(o_orderdate) AS o_orderdateDay,
       isodow(o_orderdate) - 1 AS o_orderdateDayofweek, dayofyear(o_orderdate) AS o_orderdateDayofyear,
       CAST(o_orderdate AS DATE) = last_day(o_orderdate) AS o_orderdateIs_month_end,
       day(o_orderdate) = 1 AS o_orderdateIs_month_start,
       CAST(o_orderdate AS DATE) = CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS o_orderdateIs_quarter_end,
       CAST(o_orderdate AS DATE) = CAST(date_trunc('quarter', o_orderdate) AS DATE) AS o_orderdateIs_quarter_start,
       month(o_orderdate) = 12 AND day(o_orderdate) = 31 AS o_orderdateIs_year_end,
       month(o_orderdate) = 1 AND day(o_orderdate) = 1 AS o_orderdateIs_year_start,
       CAST(epoch(o_orderdate) AS BIGINT) AS o_orderdateElapsed
FROM orders
""")
def b6_date_parts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    return C.add_date_parts(o, "o_orderdate")


@query("b7_log_target", """
SELECT l_orderkey, l_linenumber, l_partkey, round(ln(l_extendedprice), 9) AS lp, round(ln(1 + l_quantity), 9) AS lq,
       round(log10(l_extendedprice), 9) AS l10, round(exp(ln(l_extendedprice)), 6) AS back FROM lineitem
""")
def b7_log_target(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
                                               "l_quantity")
    df = C.log_target(li, "l_extendedprice", "log", "lp")
    df = C.log_target(df, "l_quantity", "log1p", "lq")
    df = C.log_target(df, "l_extendedprice", "log10", "l10")
    df = C.unlog(df, "lp", "log", "back")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", F.round("lp", 9).alias("lp"),
                     F.round("lq", 9).alias("lq"), F.round("l10", 9).alias("l10"), F.round("back", 6).alias("back"))


@query("b8_fill_median_flag", """
WITH s AS (SELECT l_orderkey, l_partkey, l_linenumber,
                  CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS q FROM lineitem),
m AS (SELECT quantile_cont(q, 0.5) AS med FROM s)
SELECT l_orderkey, l_partkey, l_linenumber, q IS NULL AS q_na, coalesce(q, m.med) AS q FROM s, m
""")
def b8_fill_median_flag(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    s = li.select("l_orderkey", "l_partkey", "l_linenumber",
                  F.when(F.col("l_returnflag") == "R", None).otherwise(F.col("l_quantity")).alias("q"))
    return C.fill_median_flag(s, ["q"])


@query("b8_fill_const", """
SELECT d.doc_id, coalesce(CAST(l.toxic AS BIGINT), 0) AS toxic, coalesce(d.lang, 'NaN') AS lang
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def b8_fill_const(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", F.col("toxic").cast("long")), "doc_id",
                                                  "left")
    return C.fill_const(j, {"toxic": 0, "lang": "NaN"}).select("doc_id", "toxic", "lang")


@query("b9_profile", """
WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'doc_id' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE doc_id IS NULL) AS n_null,
       round(count(*) FILTER (WHERE doc_id IS NULL) / count(*), 9) AS null_share FROM j
UNION ALL SELECT 'lang', count(*), count(*) FILTER (WHERE lang IS NULL), round(count(*) FILTER (WHERE lang IS NULL) / count(*), 9) FROM j
UNION ALL SELECT 'quality', count(*), count(*) FILTER (WHERE quality IS NULL), round(count(*) FILTER (WHERE quality IS NULL) / count(*), 9) FROM j
UNION ALL SELECT 'toxic', count(*), count(*) FILTER (WHERE toxic IS NULL), round(count(*) FILTER (WHERE toxic IS NULL) / count(*), 9) FROM j
""")
def b9_profile(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    p = C.profile(j)
    return p.select("column", "n_rows", "n_null", F.round("null_share", 9).alias("null_share"))


@query("b9_label_coverage", """
SELECT count(*) AS n_rows, count(l.toxic) AS n_labelled, count(*) FILTER (WHERE l.toxic IS NULL) AS n_unlabelled,
       round(count(l.toxic) / count(*), 9) AS labelled_share, count(DISTINCT l.toxic) AS n_labels
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def b9_label_coverage(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.documents.select("doc_id").join(t.labels.select("doc_id", "toxic"), "doc_id", "left")
    r = C.label_coverage(j, "toxic")
    return r.withColumn("labelled_share", F.round("labelled_share", 9))


@query("b10_search_items", """
SELECT p_partkey, p_name FROM part
WHERE (instr(lower(' ' || p_type || ' '), ' economy ') > 0 OR instr(lower(' ' || p_name || ' '), ' ring ') > 0)
  AND p_retailprice <= 1500 AND p_size > 10
""")
def b10_search_items(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    items = p.select("p_partkey", "p_name", F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("name"),
                     F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("description"),
                     F.col("p_retailprice").alias("price"), F.col("p_size").alias("quantity_in_stock"))
    ring = C.search_items(items, word="ring")
    econ = C.search_items(items, word="economy")
    hits = ring.unionByName(econ).distinct()
    return C.search_items(hits, max_price=1500.0).where(F.col("quantity_in_stock") > 10).select("p_partkey", "p_name")


@query("b10_exact_name", "SELECT p_partkey FROM part WHERE p_name = 'red widget' AND p_retailprice <= 1200")
def b10_exact_name(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", F.col("p_name").alias("name"),
                                          F.col("p_retailprice").alias("price"))
    return C.search_items(p, exact_name="red widget", max_price=1200.0).select("p_partkey")


@query("b11_search_messages", """
SELECT conv_id, turn, role FROM conversations
WHERE instr(lower(text), 'pour') > 0 AND role = 'user'
ORDER BY conv_id DESC, turn DESC LIMIT 25
""")
def b11_search_messages(spark, sf_dir):
    c = Tables(spark, sf_dir).conversations
    msgs = c.select("conv_id", "turn", "role", F.col("text").alias("body"), F.col("role").alias("sender"),
                    F.struct("conv_id", "turn").alias("ts"))
    out = C.search_messages(msgs, keyword="pour", text_cols=("body",), sender="user", limit=25)
    return out.select("conv_id", "turn", "role")


@query("b12_contains_all", """
SELECT l.l_orderkey FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE p.p_brand IN ('Brand#1', 'Brand#2')
GROUP BY l.l_orderkey HAVING count(DISTINCT p.p_brand) = 2
""")
def b12_contains_all(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.lineitem.select("l_orderkey", "l_partkey").join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    return C.contains_all_long(j, "l_orderkey", "p_brand", ["Brand#1", "Brand#2"])


@query("b12_contains_all_array", """
SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
HAVING list_has_all(list(DISTINCT p_brand), ['Brand#1', 'Brand#2'])
""")
def b12_contains_all_array(spark, sf_dir):
    """Array form of B12 on the per-order brand arrays (checked against the long form in tests)."""
    t = Tables(spark, sf_dir)
    j = t.lineitem.select("l_orderkey", "l_partkey").join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    arr = j.groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("brands"))
    return C.contains_all(arr, "brands", ["Brand#1", "Brand#2"]).select("l_orderkey")


@query("b13_annotation_lines")
def b13_annotation_lines(spark, sf_dir):
    """Per order a struct of parallel arrays (category = "<type>, <brand>", bbox from quantities) -> lines."""
    t = Tables(spark, sf_dir)
    j = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand"), "l_partkey")
    per = j.groupBy("l_orderkey").agg(
        F.collect_list(F.concat_ws(", ", "p_type", "p_brand")).alias("category"),
        F.collect_list(F.array("l_linenumber", "l_quantity", "l_quantity", "l_linenumber")).alias("bbox"))
    per = per.select(F.format_string("%d.jpg", "l_orderkey").alias("file"), F.lit(640).alias("W"),
                     F.lit(480).alias("H"), F.struct("category", "bbox").alias("objects"))
    return C.annotation_lines(per, "file", "W", "H", "objects")


# ---------------------------------------------------------------- C: joins

@query("c1_enrich", """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def c1_enrich(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return J.enrich(t.orders.select("o_orderkey", "o_custkey"),
                    t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"), "o_custkey")


@query("c2_select_ids", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def c2_select_ids(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ids = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    return J.select_ids(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), ids, "l_orderkey")


@query("c3_exclude_ids", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders v WHERE v.o_orderstatus = 'F' AND v.o_orderkey = o.o_orderkey)
  AND NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_orderpriority = '1-URGENT' AND s.o_orderkey = o.o_orderkey)
""")
def c3_exclude_ids(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    valid = o.where(F.col("o_orderstatus") == "F").select("o_orderkey")
    test = o.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")
    return J.exclude_ids(o.select("o_orderkey", "o_orderstatus", "o_orderpriority"), "o_orderkey", valid, test)


@query("c4_attach_labels", """
SELECT l.toxic, d.doc_id, d.lang, d.n_chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id
""")
def c4_attach_labels(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return J.attach_labels(t.documents.select("doc_id", "lang", "n_chars"), t.labels, "doc_id", "toxic")


@query("c5_zip_rows", """
WITH l AS (SELECT doc_id AS label_doc, toxic, row_number() OVER () - 1 AS pos FROM labels),
d AS (SELECT doc_id AS doc, lang, row_number() OVER () - 1 AS pos FROM documents)
SELECT pos, label_doc, toxic, doc, lang FROM l JOIN d USING (pos)
""")
def c5_zip_rows(spark, sf_dir):
    """Row i of labels next to row i of documents, by file position."""
    t = Tables(spark, sf_dir)
    return J.zip_rows(t.labels.select(F.col("doc_id").alias("label_doc"), "toxic"),
                      t.documents.select(F.col("doc_id").alias("doc"), "lang"))


_VOCAB_SQL = f"""
toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WP}', 1)) AS token FROM documents),
counts AS (SELECT token, count(*) AS n FROM toks GROUP BY token),
vocab AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS token_id FROM counts
          ORDER BY n DESC, token LIMIT 1000)
"""


def _vocab(spark, sf_dir, k):
    t = Tables(spark, sf_dir)
    toks = t.documents.select("doc_id", F.explode(wordpunct_tokens("text")).alias("token"))
    top = A.vocab_topk(A.token_counts(toks), k)
    # ids 1..k in (count desc, token) order; the frame is bounded by k, so a driver-side enumerate is safe
    rows = top.collect()
    vocab = spark.createDataFrame([(r["token"], i + 1) for i, r in enumerate(rows)], "token string, token_id long")
    return toks, vocab


@query("c6_lookup_ids", f"""
WITH {_VOCAB_SQL}
SELECT t.doc_id, count(*) AS n_tokens, count(*) FILTER (WHERE coalesce(v.token_id, 0) = 0) AS n_unk,
       CAST(sum(coalesce(v.token_id, 0)) AS BIGINT) AS id_sum
FROM toks t LEFT JOIN vocab v ON t.token = v.token GROUP BY t.doc_id
""")
def c6_lookup_ids(spark, sf_dir):
    toks, vocab = _vocab(spark, sf_dir, 1000)
    ids = J.lookup_ids(toks, vocab, unk_id=0)
    return ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"),
                                     F.count_if(F.col("token_id") == 0).alias("n_unk"),
                                     F.sum("token_id").cast("long").alias("id_sum"))


@query("c7_known_pairs", f"""
WITH bt AS (SELECT item_id, regexp_extract_all(lower(text), '{WP}', 1) AS a FROM benchmark),
pairs AS MATERIALIZED (SELECT item_id, i AS pos, a[i] AS src, a[i + 1] AS dst FROM bt, range(1, len(a)) r(i)),
known AS MATERIALIZED (SELECT token AS word FROM (SELECT unnest(regexp_extract_all(lower(text), '{WP}', 1)) AS token FROM documents)
          GROUP BY token HAVING count(*) >= 5)
SELECT item_id, CAST(pos AS INTEGER) AS pos, src, dst FROM pairs JOIN known a ON a.word = src JOIN known b ON b.word = dst
""")
def c7_known_pairs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    bt = t.benchmark.select("item_id", wordpunct_tokens("text").alias("a"))
    pairs = bt.select("item_id", F.posexplode(F.slice("a", 1, F.greatest(F.size("a") - 1, F.lit(0)))).alias("p0", "src"),
                      "a").select("item_id", (F.col("p0") + 1).alias("pos"), "src",
                                  F.element_at("a", F.col("p0") + 2).alias("dst"))
    counts = A.token_counts(t.documents.select(F.explode(wordpunct_tokens("text")).alias("token")))
    known = A.vocab_mincount(counts, 5).select(F.col("token").alias("word"))
    return J.known_pairs(pairs, known, known).select("item_id", "pos", "src", "dst")


@query("c9_union_all", """
WITH u AS (SELECT c_custkey AS id, 'customer' AS kind, c_nationkey AS nation FROM customer
           UNION ALL SELECT s_suppkey, 'supplier', s_nationkey FROM supplier)
SELECT kind, nation, count(*) AS n FROM u GROUP BY ALL
""")
def c9_union_all(spark, sf_dir):
    t = Tables(spark, sf_dir)
    u = J.union_all(t.customer.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"),
                                      F.col("c_nationkey").alias("nation")),
                    t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"),
                                      F.col("s_nationkey").alias("nation")))
    return u.groupBy("kind", "nation").agg(F.count(F.lit(1)).alias("n"))


@query("c10_distinct_values", "SELECT DISTINCT p_brand FROM part ORDER BY p_brand")
def c10_distinct_values(spark, sf_dir):
    return J.distinct_values(Tables(spark, sf_dir).part, "p_brand")


# ---------------------------------------------------------------- D: aggregation

@query("d1_class_balance", """
SELECT toxic, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM labels), 9) AS pct FROM labels GROUP BY toxic
""")
def d1_class_balance(spark, sf_dir):
    r = A.class_balance(Tables(spark, sf_dir).labels, "toxic")
    return r.withColumn("pct", F.round("pct", 9))


@query("d2_category_stats", """
WITH o AS (SELECT p.p_brand AS category, l.l_quantity AS v FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT category, count(*) AS count, round(avg(v), 6) AS avg_value, round(stddev_pop(v), 6) AS std_value,
       round(count(*) * avg(v), 6) AS score
FROM o WHERE lower(category) NOT IN ('brand#1', 'brand#2', 'brand#3')
GROUP BY category ORDER BY count(*) * avg(v) DESC, category LIMIT 10
""")
def d2_category_stats(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity").join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    nested = j.groupBy("l_orderkey").agg(
        F.struct(F.collect_list("p_brand").alias("category"), F.collect_list("l_quantity").alias("area")).alias("objects"))
    r = A.category_stats(nested, "objects", parts=("Brand#1", "Brand#2", "Brand#3"))
    return r.select("category", "count", F.round("avg_value", 6).alias("avg_value"),
                    F.round("std_value", 6).alias("std_value"), F.round("score", 6).alias("score"))


@query("d3_rebuild_state", f"""
WITH {PRODUCT_LOG_SQL}
SELECT product_id, CAST(sum(qty_delta) AS BIGINT) AS stock,
       arg_max(unit_price, (ts, id)) FILTER (WHERE unit_price IS NOT NULL) AS latest_price,
       round(sum(-qty_delta * unit_price) FILTER (WHERE action = 'sale'), 4) AS total_sales,
       count(*) FILTER (WHERE action = 'sale') AS n_sales
FROM product_log GROUP BY product_id
""")
def d3_rebuild_state(spark, sf_dir):
    r = A.rebuild_state(product_log(Tables(spark, sf_dir)))
    return r.withColumn("total_sales", F.round("total_sales", 4))


@query("d4_sales_by", f"""
WITH {PRODUCT_LOG_SQL}
SELECT color, round(sum(-qty_delta * unit_price), 4) AS revenue FROM product_log WHERE action = 'sale'
GROUP BY color ORDER BY sum(-qty_delta * unit_price) DESC, color LIMIT 1
""")
def d4_sales_by(spark, sf_dir):
    r = A.sales_by(product_log(Tables(spark, sf_dir)), "color", 1)
    return r.withColumn("revenue", F.round("revenue", 4))


@query("d5_period_compare", """
SELECT o_orderpriority, round(sum(o_totalprice) FILTER (WHERE year(o_orderdate) = 1996), 2) AS "1996",
       round(sum(o_totalprice) FILTER (WHERE year(o_orderdate) = 1997), 2) AS "1997"
FROM orders WHERE quarter(o_orderdate) = 1 AND year(o_orderdate) IN (1996, 1997) GROUP BY o_orderpriority
""")
def d5_period_compare(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    r = A.period_compare(o, "o_orderdate", "o_orderpriority", "o_totalprice", 1, [1996, 1997])
    return r.select("o_orderpriority", F.round("1996", 2).alias("1996"), F.round("1997", 2).alias("1997"))


@query("d6_token_counts", f"""
WITH toks AS (SELECT unnest(regexp_extract_all(lower(text), '{WP}', 1)) AS token FROM documents)
SELECT token, count(*) AS n FROM toks GROUP BY token
""")
def d6_token_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return A.token_counts(t.documents.select(F.explode(wordpunct_tokens("text")).alias("token")))


@query("d6_vocab_topk", f"""
WITH toks AS (SELECT unnest(regexp_extract_all(lower(text), '{WP}', 1)) AS token FROM documents)
SELECT token, count(*) AS n FROM toks GROUP BY token ORDER BY n DESC, token LIMIT 100
""")
def d6_vocab_topk(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return A.vocab_topk(A.token_counts(t.documents.select(F.explode(wordpunct_tokens("text")).alias("token"))), 100)


@query("d6_vocab_mincount", f"""
WITH toks AS (SELECT unnest(regexp_extract_all(lower(text), '{WP}', 1)) AS token FROM documents)
SELECT count(*) AS n_tokens FROM (SELECT token FROM toks GROUP BY token HAVING count(*) >= 10)
""")
def d6_vocab_mincount(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = A.token_counts(t.documents.select(F.explode(wordpunct_tokens("text")).alias("token")))
    return A.vocab_mincount(c, 10).agg(F.count(F.lit(1)).alias("n_tokens"))


@query("d7_cov_matrix", """
SELECT 'l_quantity' AS "row", 'l_quantity' AS col, round(var_samp(l_quantity), 6) AS cov FROM lineitem
UNION ALL SELECT 'l_quantity', 'l_discount', round(covar_samp(l_quantity, l_discount), 6) FROM lineitem
UNION ALL SELECT 'l_discount', 'l_quantity', round(covar_samp(l_discount, l_quantity), 6) FROM lineitem
UNION ALL SELECT 'l_discount', 'l_discount', round(var_samp(l_discount), 6) FROM lineitem
""")
def d7_cov_matrix(spark, sf_dir):
    r = A.cov_matrix(Tables(spark, sf_dir).lineitem, ["l_quantity", "l_discount"])
    return r.withColumn("cov", F.round("cov", 6))


@query("d8_correlate", """
SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, round(corr(l_quantity, l_extendedprice), 9) AS corr FROM lineitem
UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 9) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 9) FROM lineitem
""")
def d8_correlate(spark, sf_dir):
    r = A.correlate(Tables(spark, sf_dir).lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return r.withColumn("corr", F.round("corr", 9))


@query("d8_feature_variances", """
SELECT 'l_quantity' AS feature, round(var_pop(l_quantity), 6) AS variance FROM lineitem
UNION ALL SELECT 'l_discount', round(var_pop(l_discount), 9) FROM lineitem
UNION ALL SELECT 'l_tax', round(var_pop(l_tax), 9) FROM lineitem
""")
def d8_feature_variances(spark, sf_dir):
    r = A.feature_variances(Tables(spark, sf_dir).lineitem, ["l_quantity", "l_discount", "l_tax"])
    return r.withColumn("variance", F.when(F.col("feature") == "l_quantity", F.round("variance", 6))
                        .otherwise(F.round("variance", 9)))


_ANOVA_SQL = """
WITH per AS (SELECT l_returnflag, count(*) AS n, sum({c}) AS s, sum({c} * {c}) AS q FROM lineitem GROUP BY 1),
t AS (SELECT sum(n) AS n, count(*) AS k, sum(s) AS s, sum(q) AS q, sum(s * s / n) AS b FROM per)
SELECT '{c}' AS feature, round(((b - s * s / n) / (k - 1)) / ((q - b) / (n - k)), 6) AS f_stat FROM t
"""


@query("d8_k_best", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT * FROM ({_ANOVA_SQL.format(c=c)})" for c in ["l_quantity", "l_discount", "l_tax"]
) + ") ORDER BY f_stat DESC, feature LIMIT 2")
def d8_k_best(spark, sf_dir):
    r = A.k_best(Tables(spark, sf_dir).lineitem, ["l_quantity", "l_discount", "l_tax"], "l_returnflag", 2)
    return r.withColumn("f_stat", F.round("f_stat", 6))


@query("d9_user_profile", """
SELECT user_id, round(sum(CAST(value AS DECIMAL(28, 12)))::DOUBLE / count(value), 4) AS mean_amount, round(quantile_cont(value, 0.5), 4) AS median_amount,
       round(stddev_samp(value), 4) AS std_amount, count(*) AS n_events,
       round(count(*) / count(DISTINCT CAST(ts AS DATE)), 6) AS events_per_day
FROM events GROUP BY user_id
""")
def d9_user_profile(spark, sf_dir):
    r = A.user_profile(Tables(spark, sf_dir).events, "user_id", "value", "ts")
    return r.select("user_id", *[F.round(c, 4).alias(c) for c in
                                 ["mean_amount", "median_amount", "std_amount"]], "n_events",
                    F.round("events_per_day", 6).alias("events_per_day"))


@query("d10_domain_share", r"""
WITH u AS (SELECT page_id, regexp_extract_all(url, '(?i)https?://[^\s\])>}]+', 0) AS urls FROM pages),
x AS (SELECT page_id, len(urls) AS n_urls,
             len(list_filter(urls, lambda s: instr(split_part(s, '/', 3), 'example.com') > 0
                                      OR instr(split_part(s, '/', 3), 'example.org') > 0)) AS n_preferred FROM u)
SELECT page_id, n_urls, n_preferred,
       CASE WHEN n_urls > 0 THEN n_preferred / n_urls ELSE 0.0 END AS ratio,
       n_urls > 0 AND (CASE WHEN n_urls > 0 THEN n_preferred / n_urls ELSE 0.0 END) >= 0.4 AS passed
FROM x
""")
def d10_domain_share(spark, sf_dir):
    p = Tables(spark, sf_dir).pages.select("page_id", "url")
    return A.domain_share(p, "url", ["example.com", "example.org"], 0.4).drop("url")


@query("d11_top_k", """
SELECT doc_id, n_chars FROM documents ORDER BY n_chars, doc_id LIMIT 100
""")
def d11_top_k(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "n_chars")
    return A.top_k(d, ["n_chars", "doc_id"], 100)


@query("d12_histogram", """
WITH mm AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM documents),
b AS (SELECT CAST(least(floor((n_chars - lo) / ((hi - lo) / 20.0)), 19) AS INTEGER) AS bin, lo, hi FROM documents, mm)
SELECT bin, count(*) AS n, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 20.0, 6) AS lo,
       round(any_value(lo) + (bin + 1) * (any_value(hi) - any_value(lo)) / 20.0, 6) AS hi FROM b GROUP BY bin
""")
def d12_histogram(spark, sf_dir):
    r = A.histogram(Tables(spark, sf_dir).documents, "n_chars", 20)
    return r.withColumn("lo", F.round("lo", 6)).withColumn("hi", F.round("hi", 6))
