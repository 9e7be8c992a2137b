"""Queries over the driver's tables, each an operator seen through a lens, with the SQL that gives the same rows.

Lenses: *events* as genes (user = genome, user and day = contig, time = place,
type and property = cluster); *lineitem* as genes (supplier = genome, order =
contig, part = cluster); *documents* as DNA (letters folded onto ACGT).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.functions import codons
from strandloom.functions import sequences as S
from strandloom.functions import text as X
from strandloom.operators import alignment as A
from strandloom.operators import graph as G
from strandloom.operators import positions as P
from strandloom.operators import relations as R
from strandloom.operators import sets as T
from strandloom.operators import similarity as C
from strandloom.operators import support as U

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

GENES = """genes AS (SELECT user_id AS genome, strftime(ts, '%Y-%m-%d') AS contig, event_id, ts,
  event_type || '_' || CAST(CAST(props->>'$.k' AS BIGINT) % 20 AS VARCHAR) AS node,
  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS pos FROM events)"""
ADJ = GENES + """, adj AS (SELECT * FROM (SELECT *, lag(node) OVER (PARTITION BY genome, contig ORDER BY pos) AS prev_node FROM genes) WHERE prev_node IS NOT NULL),
em AS (SELECT DISTINCT least(prev_node, node) AS u, greatest(prev_node, node) AS v, genome FROM adj)"""
BOTH = ADJ + """, two AS (SELECT u AS a, v AS b, genome FROM em UNION SELECT v, u, genome FROM em)"""
_CYCLE = ("ACGT" * 7)[:26]
DNA = f"""dna AS (SELECT doc_id, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', '{_CYCLE}') AS seq FROM documents)"""
_FROM, _TO = S.COMPLEMENT


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def genes(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("long") % 20
    g = e.select(F.col("user_id").alias("genome"), F.date_format("ts", "yyyy-MM-dd").alias("contig"), "event_id", "ts", F.concat_ws("_", "event_type", k.cast("string")).alias("node"))
    return P.gene_index(g, ["genome", "contig"], ["ts", "event_id"])


def adjacent(spark: SparkSession, d: str) -> DataFrame:
    return P.adjacency(genes(spark, d), ["genome", "contig"], "pos", "node")


def edge_genomes(spark: SparkSession, d: str) -> DataFrame:
    return U.edge_members(adjacent(spark, d), "prev_node", "node", "genome")


def dna(spark: SparkSession, d: str) -> DataFrame:
    letters = F.regexp_replace(F.lower("text"), "[^a-z]", "")
    return table(spark, d, "documents").select("doc_id", F.translate(letters, "abcdefghijklmnopqrstuvwxyz", _CYCLE).alias("seq"))


def genomes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").agg(F.countDistinct("user_id").alias("n"))


# ---- positions


@query("gene_index", "SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, CAST(row_number() OVER (PARTITION BY l_suppkey, l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS BIGINT) AS pos FROM lineitem")
def gene_index(spark, d):
    li = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    return P.gene_index(li, ["l_suppkey", "l_orderkey"], ["l_linenumber", "l_partkey"])


@query("contig_rank", f"WITH {GENES}, f AS (SELECT genome, contig, min(event_id) AS first FROM genes GROUP BY ALL) SELECT genome, contig, CAST(dense_rank() OVER (PARTITION BY genome ORDER BY first, contig) - 1 AS BIGINT) AS contig_rank FROM f")
def contig_rank(spark, d):
    return P.contig_rank(genes(spark, d), "genome", "contig", "event_id")


@query("adjacency_edges", f"WITH {ADJ} SELECT genome, contig, CAST(pos AS BIGINT) AS pos, least(prev_node, node) AS u, greatest(prev_node, node) AS v FROM adj")
def adjacency_edges(spark, d):
    return adjacent(spark, d).select("genome", "contig", "pos", F.least("prev_node", "node").alias("u"), F.greatest("prev_node", "node").alias("v"))


@query("contig_ends", f"WITH {GENES} SELECT genome, contig, CAST(pos AS BIGINT) AS pos, node, (pos = 0 OR pos = max(pos) OVER (PARTITION BY genome, contig)) AS has_end FROM genes")
def contig_ends(spark, d):
    return P.contig_ends(genes(spark, d), ["genome", "contig"], "pos").select("genome", "contig", "pos", "node", "has_end")


@query("paralog_copy_ids", f"WITH {GENES}, p AS (SELECT node FROM genes GROUP BY node HAVING count(*) <> count(DISTINCT genome)) SELECT genome, contig, CAST(pos AS BIGINT) AS pos, node AS cluster, CAST((SELECT count(DISTINCT node) FROM genes) + row_number() OVER (ORDER BY genome, contig, pos) AS BIGINT) AS node FROM genes WHERE node IN (SELECT node FROM p)")
def paralog_copy_ids(spark, d):
    g = genes(spark, d)
    n = g.agg(F.countDistinct("node")).first()[0]
    return P.paralog_copy_ids(g.withColumnRenamed("node", "cluster"), "genome", "cluster", ["genome", "contig", "pos"], n).select("genome", "contig", "pos", "cluster", "node")


@query("running_header", "SELECT p_brand, p_partkey, CAST(p_size AS BIGINT) AS p_size, CAST(sum(p_size) OVER w - p_size + 1 AS BIGINT) AS start, CAST(sum(p_size) OVER w AS BIGINT) AS \"end\" FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey)")
def running_header(spark, d):
    part = table(spark, d, "part").select("p_brand", "p_partkey", F.col("p_size").cast("long").alias("p_size"))
    return P.running_spans(part, ["p_partkey"], "p_size", ["p_brand"]).select("p_brand", "p_partkey", "p_size", "start", "end")


@query("unique_names", "WITH m AS (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_partkey) > 1 OR p_name = '' AS again FROM part) SELECT p_partkey, p_name, CASE WHEN again THEN 'group_' || CAST(sum(CAST(again AS INT)) OVER (ORDER BY p_partkey) - 1 AS VARCHAR) ELSE p_name END AS unique_name FROM m")
def unique_names(spark, d):
    return P.unique_names(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", ["p_partkey"])


@query("duplicate_ids", "WITH n AS (SELECT p_brand, p_partkey, p_name, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) - 1 AS k FROM part) SELECT p_brand, p_partkey, CASE WHEN k = 0 THEN p_name ELSE p_name || '_' || CAST(k AS VARCHAR) END AS unique_id FROM n")
def duplicate_ids(spark, d):
    return P.unique_ids(table(spark, d, "part").select("p_brand", "p_partkey", "p_name"), ["p_brand"], "p_name", ["p_partkey"]).select("p_brand", "p_partkey", "unique_id")


@query("refound_counter", f"WITH {GENES} SELECT genome || '_refound_' || CAST(row_number() OVER (ORDER BY genome, contig, pos) - 1 AS VARCHAR) AS refound_id, genome, contig, CAST(pos AS BIGINT) AS pos FROM genes")
def refound_counter(spark, d):
    n = P.numbered(genes(spark, d).select("genome", "contig", "pos"), ["genome", "contig", "pos"], 0, "k")
    return n.select(F.concat_ws("_", F.col("genome").cast("string"), F.lit("refound"), F.col("k").cast("string")).alias("refound_id"), "genome", "contig", "pos")


# ---- support and reports


@query("node_rollup", f"WITH {GENES}, g AS (SELECT *, (pos = 0 OR pos = max(pos) OVER (PARTITION BY genome, contig)) AS e FROM genes) SELECT node, count(*) AS size, count(DISTINCT genome) AS n_genomes, bool_or(e) AS has_end FROM g GROUP BY node")
def node_rollup(spark, d):
    return U.node_support(P.contig_ends(genes(spark, d), ["genome", "contig"], "pos"), "node", "genome", "has_end")


@query("edge_support", f"WITH {ADJ} SELECT least(prev_node, node) AS u, greatest(prev_node, node) AS v, count(*) AS traversals, count(DISTINCT genome) AS n_genomes FROM adj GROUP BY 1, 2")
def edge_support(spark, d):
    return U.edge_support(adjacent(spark, d), "prev_node", "node", "genome")


@query("paralog_clusters", f"WITH {GENES} SELECT node, count(*) AS occurrences, count(DISTINCT genome) AS n_genomes, count(*) <> count(DISTINCT genome) AS paralog FROM genes GROUP BY node")
def paralog_clusters(spark, d):
    return U.is_paralog(genes(spark, d), "node", "genome")


_CLASS = "CASE WHEN n * 100.0 / t >= 99 THEN 'core' WHEN n * 100.0 / t >= 95 THEN 'soft_core' WHEN n * 100.0 / t >= 15 THEN 'shell' ELSE 'cloud' END"
_GRAINS = """grains AS (SELECT user_id AS genome, event_type AS node FROM events
UNION SELECT user_id, event_type || '_' || CAST(CAST(props->>'$.k' AS BIGINT) % 20 AS VARCHAR) FROM events
UNION SELECT user_id, event_type || '=' || (props->>'$.k') FROM events),
n AS (SELECT node, count(*) AS n, (SELECT count(DISTINCT user_id) FROM events) AS t FROM grains GROUP BY node)"""


def grains(spark, d):
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    names = F.array("event_type", F.concat_ws("_", "event_type", (k.cast("long") % 20).cast("string")), F.concat_ws("=", "event_type", k))
    return e.select(F.col("user_id").alias("genome"), F.explode(names).alias("node")).distinct().groupBy("node").agg(F.count("*").alias("n_genomes"))


@query("pangenome_classes", f"WITH {_GRAINS} SELECT c.class, count(x.node) AS n_nodes FROM (VALUES ('core'), ('soft_core'), ('shell'), ('cloud')) c(class) LEFT JOIN (SELECT node, {_CLASS} AS class FROM n) x USING (class) GROUP BY c.class UNION ALL SELECT 'total', count(*) FROM n")
def pangenome_classes(spark, d):
    return U.class_counts(grains(spark, d), "n_genomes", genomes(spark, d))


@query("node_classes", f"WITH {_GRAINS} SELECT node, n AS n_genomes, {_CLASS} AS class FROM n")
def node_classes(spark, d):
    t = genomes(spark, d)
    return grains(spark, d).crossJoin(F.broadcast(t)).select("node", "n_genomes", U.class_of(F.col("n_genomes"), F.col("n")).alias("class"))


@query("pangenome_report", f"WITH {ADJ}, t AS (SELECT count(DISTINCT genome) AS t FROM genes), n AS (SELECT node, count(*) AS size, count(DISTINCT genome) AS n FROM genes GROUP BY node), c AS (SELECT node, size, n, {_CLASS} AS class FROM n, t), e AS (SELECT least(prev_node, node) AS u, greatest(prev_node, node) AS v, count(*) AS traversals, count(DISTINCT genome) AS n_genomes FROM adj GROUP BY 1, 2) SELECT u, v, traversals, n_genomes, a.size AS size_u, b.size AS size_v, a.class AS class_u, b.class AS class_v FROM e JOIN c a ON a.node = u JOIN c b ON b.node = v")
def pangenome_report(spark, d):
    """Edge support with the classes of both nodes: adjacency, support and classes in one."""
    g = genes(spark, d)
    n = U.node_support(g, "node", "genome").crossJoin(F.broadcast(genomes(spark, d))).select("node", "size", U.class_of(F.col("n_genomes"), F.col("n")).alias("class"))
    e = U.edge_support(P.adjacency(g, ["genome", "contig"], "pos", "node"), "prev_node", "node", "genome")
    e = e.join(n.toDF("u", "size_u", "class_u"), "u").join(n.toDF("v", "size_v", "class_v"), "v")
    return e.select("u", "v", "traversals", "n_genomes", "size_u", "size_v", "class_u", "class_v")


_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("presence_matrix", "WITH s AS (SELECT DISTINCT l_partkey, n_regionkey AS r, s_suppkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey) SELECT l_partkey, " + ", ".join(f"coalesce(string_agg(CAST(s_suppkey AS VARCHAR), ';' ORDER BY CAST(s_suppkey AS VARCHAR)) FILTER (r = {i}), '') AS r{i}" for i in range(5)) + " FROM s GROUP BY l_partkey")
def presence_matrix(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.concat(F.lit("r"), "n_regionkey").alias("r"))
    rows = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).withColumn("s", F.col("s_suppkey").cast("string"))
    return U.presence_matrix(rows, "l_partkey", "r", "s", [f"r{i}" for i in range(5)])


@query("presence_calls", "WITH s AS (SELECT DISTINCT l_partkey, n_regionkey AS r FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey) SELECT l_partkey, " + ", ".join(f"CAST(count(*) FILTER (r = {i}) AS INTEGER) AS r{i}" for i in range(5)) + " FROM s GROUP BY l_partkey")
def presence_calls(spark, d):
    return U.presence_calls(presence_matrix(spark, d), "l_partkey")


@query("core_genes", f"WITH {_GRAINS} SELECT node, n AS n_genomes FROM n WHERE CAST(n AS DOUBLE) / t >= 0.95")
def core_genes(spark, d):
    return U.core_nodes(grains(spark, d), "n_genomes", genomes(spark, d), 0.95)


@query("core_subset", f"WITH {_GRAINS} SELECT node, n AS n_genomes FROM n WHERE CAST(n AS DOUBLE) / t >= 0.3 ORDER BY node LIMIT 3")
def core_subset(spark, d):
    return U.core_subset(U.core_nodes(grains(spark, d), "n_genomes", genomes(spark, d), 0.3), ["node"], 3)


@query("matrix_order", f"WITH {GENES}, n AS (SELECT node, count(DISTINCT genome) AS n_isolates, min(event_id) AS entry FROM genes GROUP BY node) SELECT node, n_isolates, CAST(row_number() OVER (ORDER BY n_isolates DESC, entry DESC) - 1 AS BIGINT) AS place FROM n")
def matrix_order(spark, d):
    n = genes(spark, d).groupBy("node").agg(F.countDistinct("genome").alias("n_isolates"), F.min("event_id").alias("entry"))
    return P.numbered(n.withColumn("_a", -F.col("n_isolates")).withColumn("_b", -F.col("entry")), ["_a", "_b"], 0, "place").select("node", "n_isolates", "place")


@query("length_stats_mode", "WITH v AS (SELECT l_suppkey, CAST(l_quantity AS BIGINT) AS q, l_orderkey * 100 + l_linenumber AS o FROM lineitem), m AS (SELECT l_suppkey, q, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, min(o)) AS r FROM v GROUP BY l_suppkey, q) SELECT v.l_suppkey, min(v.q) AS len_min, max(v.q) AS len_max, CAST(sum(v.q) AS DOUBLE) / count(*) AS len_mean, any_value(m.q) AS len_mode FROM v JOIN m ON m.l_suppkey = v.l_suppkey AND r = 1 GROUP BY v.l_suppkey")
def length_stats_mode(spark, d):
    v = table(spark, d, "lineitem").select("l_suppkey", F.col("l_quantity").cast("long").alias("q"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("o"))
    return P.first_mode(v, ["l_suppkey"], "q", "o")


@query("longest_member", "SELECT p_brand, max(length(p_name)) AS len, max(CASE WHEN length(p_name) = m THEN p_name END) AS longest FROM (SELECT *, max(length(p_name)) OVER (PARTITION BY p_brand) AS m FROM part) GROUP BY p_brand")
def longest_member(spark, d):
    best = table(spark, d, "part").groupBy("p_brand").agg(F.max(F.struct(F.length("p_name").cast("long").alias("len"), "p_name")).alias("b"))
    return best.select("p_brand", "b.len", F.col("b.p_name").alias("longest"))


@query("last_longest_index", "SELECT p_brand, max(p_partkey) FILTER (length(p_name) = m) AS last_longest FROM (SELECT *, max(length(p_name)) OVER (PARTITION BY p_brand) AS m FROM part) GROUP BY p_brand")
def last_longest_index(spark, d):
    return table(spark, d, "part").groupBy("p_brand").agg(F.max_by("p_partkey", F.struct(F.length("p_name"), "p_partkey")).alias("last_longest"))


@query("ordered_distinct", "WITH f AS (SELECT p_brand, p_type, min(p_partkey) AS k FROM part GROUP BY 1, 2) SELECT p_brand, string_agg(p_type, ';' ORDER BY k) AS types FROM f GROUP BY p_brand")
def ordered_distinct(spark, d):
    f = F.array_sort(F.collect_list(F.struct("p_partkey", "p_type")))
    return table(spark, d, "part").groupBy("p_brand").agg(F.array_join(F.array_distinct(F.transform(f, lambda x: x["p_type"])), ";").alias("types"))


_MEMBERS = GENES + ", members AS (SELECT DISTINCT split_part(node, '_', 1) AS grp, node, genome FROM genes)"


def members(spark, d):
    g = genes(spark, d)
    return g.select(F.substring_index("node", "_", 1).alias("grp"), "node", "genome").distinct()


@query("clash_members", f"WITH {_MEMBERS} SELECT grp, genome, count(*) AS n_nodes FROM members GROUP BY 1, 2 HAVING count(*) > 1")
def clash_members(spark, d):
    return U.clashing(members(spark, d), "grp", "genome")


@query("singleton_fraction", f"WITH {_MEMBERS}, e AS (SELECT grp, genome, count(*) AS k FROM members GROUP BY 1, 2) SELECT grp, count(*) FILTER (k = 1) AS ones, count(*) AS genomes, CAST(count(*) FILTER (k = 1) AS DOUBLE) / count(*) AS share FROM e GROUP BY grp")
def singleton_fraction(spark, d):
    return U.singleton_share(members(spark, d), "grp", "genome")


@query("edge_overuse", f"WITH {BOTH} SELECT a AS node, genome, count(*) AS n_edges FROM two GROUP BY 1, 2 HAVING count(*) > 3")
def edge_overuse(spark, d):
    e = edge_genomes(spark, d)
    two = e.select(F.col("u").alias("node"), F.col("v").alias("other"), "genome").union(e.select("v", "u", "genome")).distinct()
    return U.overused(two, "node", "genome")


@query("consensus_removal", f"WITH {ADJ}, h AS (SELECT prev_node AS node, count(*) AS n_hits FROM adj GROUP BY 1), n AS (SELECT node, count(DISTINCT genome) AS size FROM genes GROUP BY 1) SELECT node, n_hits, size FROM h JOIN n USING (node) WHERE n_hits > size")
def consensus_removal(spark, d):
    hits = adjacent(spark, d).select(F.col("prev_node").alias("node"))
    n = genes(spark, d).groupBy("node").agg(F.countDistinct("genome").alias("size"))
    return U.consensus_removal(hits, n, "node", "size")


@query("length_outliers", "SELECT p_partkey, (abs(p_size - 10) / CAST(10 AS DOUBLE)) > 0.05 * 10 AS outlier FROM part")
def length_outliers(spark, d):
    return table(spark, d, "part").select("p_partkey", U.length_outlier(F.col("p_size").cast("double"), F.lit(10.0)).alias("outlier"))


# ---- joins


@query("missing_in_genome", f"WITH {BOTH}, m AS (SELECT DISTINCT node, genome FROM genes), p AS (SELECT DISTINCT a, b FROM two) SELECT DISTINCT p.a AS node, p.b AS neighbour, m.genome FROM p JOIN m ON m.node = p.b WHERE NOT EXISTS (SELECT 1 FROM m x WHERE x.node = p.a AND x.genome = m.genome)")
def missing_in_genome(spark, d):
    pairs = G.both_ways(edge_genomes(spark, d), "u", "v").toDF("node", "neighbour")
    return R.missing_pairs(pairs, genes(spark, d).select("node", "genome").distinct(), "node", "neighbour", "genome")


@query("conflict_pairs", f"WITH {BOTH} SELECT DISTINCT t.genome, t.b AS neighbour, g.event_id FROM two t JOIN genes g ON g.node = t.b AND g.genome = t.genome")
def conflict_pairs(spark, d):
    e = edge_genomes(spark, d)
    two = e.select(F.col("v").alias("neighbour"), "genome").union(e.select("u", "genome")).distinct()
    j = two.join(genes(spark, d).select(F.col("node").alias("neighbour"), "genome", "event_id"), ["neighbour", "genome"])
    return R.conflict_pairs(j, "genome", "neighbour", "event_id")


@query("centroid_semi", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def centroid_semi(spark, d):
    c = table(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").join(c, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query("cluster_lookup", "SELECT l_orderkey, l_linenumber, l_partkey, p_brand, s_name FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey")
def cluster_lookup(spark, d):
    li, p, s = (table(spark, d, t) for t in ("lineitem", "part", "supplier"))
    return li.join(p, F.col("l_partkey") == F.col("p_partkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "l_linenumber", "l_partkey", "p_brand", "s_name")


@query("id_fallback", "SELECT c_custkey, coalesce(CAST(o.k AS VARCHAR), CAST(c_custkey AS VARCHAR)) AS shown FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS k FROM orders GROUP BY 1) o ON o_custkey = c_custkey")
def id_fallback(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("id")).agg(F.min("o_orderkey").cast("string").alias("original"))
    c = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("id"))
    return R.id_or_original(c, o, "id", "original", "shown").select("c_custkey", "shown")


@query("key_set_equality", "WITH a AS (SELECT c_custkey AS k, count(*) AS in_a FROM customer GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS in_b FROM orders GROUP BY 1) SELECT coalesce(a.k, b.k) AS k, coalesce(in_a, 0) AS in_a, coalesce(in_b, 0) AS in_b FROM a FULL JOIN b ON a.k = b.k WHERE coalesce(in_a, 0) <> 1 OR coalesce(in_b, 0) <> 1")
def key_set_equality(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return R.key_differences(a, table(spark, d, "orders").select(F.col("o_custkey").alias("k")), "k")


@query("own_or_longest", "SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, CASE WHEN row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey * 100 + l_linenumber) = 1 THEN l_quantity ELSE max(l_quantity) OVER (PARTITION BY l_partkey) END AS dna FROM lineitem")
def own_or_longest(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("o"))
    li = li.join(li.groupBy("l_partkey").agg(F.max("l_quantity").alias("longest")), "l_partkey")
    return R.own_or_longest(li, "l_partkey", "l_suppkey", "o", "l_quantity", "longest").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "dna")


_SPANS = "sp AS (SELECT l_suppkey AS g, l_orderkey AS id, l_partkey * 10 AS s, l_partkey * 10 + CAST(l_quantity AS BIGINT) AS e FROM lineitem)"


def spans(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("g"), F.col("l_orderkey").alias("id"), (F.col("l_partkey") * 10).alias("s"), (F.col("l_partkey") * 10 + F.col("l_quantity").cast("long")).alias("e"))


@query("interval_overlap", f"WITH {_SPANS} SELECT a.g, a.id AS id_a, b.id AS id_b, a.s AS s_a, b.s AS s_b FROM sp a JOIN sp b ON a.g = b.g AND a.id < b.id AND a.s < b.e AND b.s < a.e")
def interval_overlap(spark, d):
    a, b = spans(spark, d).toDF("g", "id_a", "s_a", "e_a"), spans(spark, d).toDF("g", "id_b", "s_b", "e_b")
    return R.overlaps(a, b, ["g"], 100, ("s_a", "e_a"), ("s_b", "e_b")).where("id_a < id_b").select("g", "id_a", "id_b", "s_a", "s_b")


@query("radius_slice", f"WITH {DNA} SELECT doc_id, substr(seq, greatest(0, 100 - 60) + 1, greatest(least(length(seq), 130 + 60) - greatest(0, 100 - 60), 0)) AS part FROM dna")
def radius_slice(spark, d):
    return dna(spark, d).select("doc_id", R.radius_slice(F.col("seq"), F.lit(100), F.lit(130), 60).alias("part"))


@query("accepted_hits", f"WITH {GENES}, bn AS (SELECT node FROM genes GROUP BY node HAVING count(*) < 95), bp AS (SELECT DISTINCT node, genome FROM genes WHERE pos = 0) SELECT node, genome, CAST(pos AS BIGINT) AS pos, contig FROM genes g WHERE node NOT IN (SELECT node FROM bn) AND NOT EXISTS (SELECT 1 FROM bp WHERE bp.node = g.node AND bp.genome = g.genome)")
def accepted_hits(spark, d):
    g = genes(spark, d).select("node", "genome", "pos", "contig")
    bad = g.groupBy("node").agg(F.count("*").alias("k")).where("k < 95").select("node")
    return R.accepted_hits(g, bad, g.where("pos = 0").select("node", "genome").distinct(), "node", "genome", "contig").select("node", "genome", "pos", "contig")


@query("pairs_in_block", "SELECT a.source, a.lang, a.doc_id AS a, b.doc_id AS b FROM documents a JOIN documents b ON a.source = b.source AND a.lang = b.lang AND a.doc_id < b.doc_id")
def pairs_in_block(spark, d):
    return R.pairs_in_block(table(spark, d, "documents").select("source", "lang", "doc_id"), ["source", "lang"], "doc_id", []).select("source", "lang", "a", "b")


@query("structural_variants", f"WITH {BOTH}, t AS (SELECT * FROM two WHERE a IN (SELECT a FROM two GROUP BY a HAVING count(DISTINCT b) >= 3)) SELECT x.a AS node, x.b AS a, y.b AS b, count(*) AS support FROM t x JOIN t y ON x.a = y.a AND x.genome = y.genome AND x.b < y.b GROUP BY 1, 2, 3 HAVING count(*) >= 2")
def structural_variants(spark, d):
    e = edge_genomes(spark, d)
    two = e.select(F.col("u").alias("node"), F.col("v").alias("other"), "genome").union(e.select("v", "u", "genome")).distinct()
    return R.edge_pairs(two, 2)


@query("gap_filled_concat", "WITH iso AS (SELECT DISTINCT n_nationkey AS i FROM nation), g AS (SELECT p_partkey AS gene, CAST(1 + p_size % 7 AS BIGINT) AS len FROM part), a AS (SELECT DISTINCT s_nationkey AS i, l_partkey AS gene FROM lineitem JOIN supplier ON s_suppkey = l_suppkey) SELECT i, string_agg(CASE WHEN a.gene IS NULL THEN repeat('-', CAST(len AS INT)) ELSE repeat('A', CAST(len AS INT)) END, '' ORDER BY g.gene) AS seq FROM iso CROSS JOIN g LEFT JOIN a USING (i, gene) GROUP BY i")
def gap_filled_concat(spark, d):
    iso = table(spark, d, "nation").select(F.col("n_nationkey").alias("i"))
    g = table(spark, d, "part").select(F.col("p_partkey").alias("gene"), (1 + F.col("p_size") % 7).cast("long").alias("len"))
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("i"))
    have = table(spark, d, "lineitem").select("l_suppkey", F.col("l_partkey").alias("gene")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).select("i", "gene").distinct()
    have = have.join(g, "gene").select("i", "gene", F.repeat(F.lit("A"), F.col("len").cast("int")).alias("seq"))
    return A.concatenated(R.gap_filled(iso, g, have, "i", "gene", "seq", "len"), "i", "seq", "gene")


# ---- sets

_SETS = GENES + """, p AS (SELECT DISTINCT u, v FROM (SELECT least(prev_node, node) AS u, greatest(prev_node, node) AS v FROM (SELECT node, lag(node) OVER (PARTITION BY genome, contig ORDER BY pos) AS prev_node FROM genes)) WHERE u <> v),
m AS (SELECT node, list_sort(list(DISTINCT genome)) AS g FROM genes GROUP BY node)"""


def set_pairs(spark, d):
    m = T.members_of(genes(spark, d), "node", "genome", "g")
    p = edge_genomes(spark, d).select("u", "v").where("u <> v").distinct()
    return p.join(m.toDF("u", "a"), "u").join(m.toDF("v", "b"), "v")


@query("set_union", f"WITH {_SETS} SELECT u, v, array_to_string(list_sort(list_distinct(list_concat(a.g, b.g))), ',') AS members FROM p JOIN m a ON a.node = u JOIN m b ON b.node = v")
def set_union(spark, d):
    return set_pairs(spark, d).select("u", "v", F.array_join(T.union(F.col("a"), F.col("b")).cast("array<string>"), ",").alias("members"))


@query("set_intersection", f"WITH {_SETS} SELECT u, v, array_to_string(list_sort(list_intersect(a.g, b.g)), ',') AS members FROM p JOIN m a ON a.node = u JOIN m b ON b.node = v")
def set_intersection(spark, d):
    return set_pairs(spark, d).select("u", "v", F.array_join(T.intersection(F.col("a"), F.col("b")).cast("array<string>"), ",").alias("members"))


@query("set_difference", f"WITH {_SETS} SELECT u, v, array_to_string(list_sort(list_filter(a.g, lambda x: NOT list_contains(b.g, x))), ',') AS members FROM p JOIN m a ON a.node = u JOIN m b ON b.node = v")
def set_difference(spark, d):
    return set_pairs(spark, d).select("u", "v", F.array_join(T.difference(F.col("a"), F.col("b")).cast("array<string>"), ",").alias("members"))


@query("set_disjoint", f"WITH {_SETS} SELECT u, v, NOT list_has_any(a.g, b.g) AS is_disjoint FROM p JOIN m a ON a.node = u JOIN m b ON b.node = v")
def set_disjoint(spark, d):
    return set_pairs(spark, d).select("u", "v", T.disjoint(F.col("a"), F.col("b")).alias("is_disjoint"))


@query("set_bitmap_sizes", f"WITH {GENES} SELECT node, count(DISTINCT genome) AS n FROM genes GROUP BY node")
def set_bitmap_sizes(spark, d):
    return T.bitmap_of(genes(spark, d), "node", "genome").groupBy("node").agg(F.sum(F.bitmap_count("bits")).alias("n"))


@query("shared_members", f"WITH {_SETS} SELECT u, v, CAST(len(list_intersect(a.g, b.g)) AS BIGINT) AS shared FROM p JOIN m a ON a.node = u JOIN m b ON b.node = v WHERE list_has_any(a.g, b.g)")
def shared_members(spark, d):
    p = edge_genomes(spark, d).select("u", "v").where("u <> v").distinct()
    return T.shared_pairs(genes(spark, d), "node", "genome", p, "u", "v")


# ---- graphs: events of a user are linked in the order of time, so every user is a chain

_LINKS = """pl AS (SELECT user_id, CAST(event_id AS VARCHAR) AS node, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p, count(*) OVER (PARTITION BY user_id) AS k FROM events),
links AS (SELECT x.node AS src, y.node AS dst FROM pl x JOIN pl y ON x.user_id = y.user_id AND y.p = x.p + 1)"""


def links(spark, d):
    e = table(spark, d, "events").select("user_id", F.col("event_id").cast("string").alias("src"), F.lead("event_id").over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("string").alias("dst"))
    return e.where("dst is not null").select("src", "dst")


@query("components", f"WITH {_LINKS} SELECT node, min(node) OVER (PARTITION BY user_id) AS component FROM pl WHERE k > 1")
def components(spark, d):
    c = G.connected_components(links(spark, d))
    return c.join(c.groupBy("component").agg(F.min("node").alias("m")), "component").select("node", F.col("m").alias("component"))


@query("component_order", f"WITH {_LINKS}, c AS (SELECT node, min(node) OVER (PARTITION BY user_id) AS component FROM pl WHERE k > 1) SELECT node, CAST(dense_rank() OVER (ORDER BY component) AS BIGINT) AS fragment, CAST(row_number() OVER (PARTITION BY component ORDER BY node) AS BIGINT) AS place FROM c")
def component_order(spark, d):
    e = links(spark, d)
    n = e.select(F.col("src").alias("node")).union(e.select("dst")).distinct().withColumn("ord", F.col("node"))
    return G.component_numbers(e, n, "node", "ord").select("node", "fragment", "place")


@query("k_hop", f"WITH {_LINKS} SELECT x.node AS seed, y.node, CAST(abs(x.p - y.p) AS INTEGER) AS depth FROM pl x JOIN pl y ON x.user_id = y.user_id AND abs(x.p - y.p) <= 3 WHERE x.k > 1")
def k_hop(spark, d):
    e = links(spark, d)
    return G.k_hop(e, e.select(F.col("src").alias("node")).union(e.select("dst")).distinct(), 3)


@query("shortest_path", f"WITH {_LINKS} SELECT x.node AS a, y.node AS b, CAST(CASE WHEN y.p - x.p <= 4 THEN y.p - x.p END AS INTEGER) AS steps FROM pl x JOIN pl y ON x.user_id = y.user_id AND y.p - x.p BETWEEN 1 AND 6")
def shortest_path(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    later = F.array(*(F.lead("event_id", i).over(w).cast("string") for i in range(1, 7)))
    pairs = table(spark, d, "events").select(F.col("event_id").cast("string").alias("a"), later.alias("later")).select("a", F.explode("later").alias("b")).where("b is not null")
    return G.shortest_paths(links(spark, d), pairs, 4).select("a", "b", "steps")


_EDGES = ADJ + """, ed AS (SELECT u, v, count(*) AS size FROM em WHERE u <> v GROUP BY 1, 2), nd AS (SELECT node, count(DISTINCT genome) AS size FROM genes GROUP BY 1)"""


@query("trim_tips", f"WITH {_LINKS}, n0 AS (SELECT node, CAST(node AS BIGINT) % 7 AS size FROM pl WHERE k > 1), " + ", ".join(f"d{i} AS (SELECT node FROM n{i} LEFT JOIN (SELECT x, count(*) AS k FROM (SELECT unnest([src, dst]) AS x FROM links WHERE src IN (SELECT node FROM n{i}) AND dst IN (SELECT node FROM n{i})) GROUP BY x) ON x = node WHERE coalesce(k, 0) <= 1 AND size < 4), n{i + 1} AS (SELECT * FROM n{i} WHERE node NOT IN (SELECT node FROM d{i}))" for i in range(3)) + " SELECT node, CAST(size AS INTEGER) AS size FROM n3")
def trim_tips(spark, d):
    e = links(spark, d)
    n = e.select(F.col("src").alias("node")).union(e.select("dst")).distinct().withColumn("size", (F.col("node").cast("long") % 7).cast("int"))
    return G.trim_tips(n, e, "node", "size", 4, 3)[0].select("node", "size")


@query("clean_edges", f"WITH {_EDGES}, en AS (SELECT node, bool_or(pos = 0) AS e FROM genes GROUP BY node) SELECT u, v, ed.size FROM ed JOIN nd a ON a.node = u JOIN nd b ON b.node = v JOIN en x ON x.node = u JOIN en y ON y.node = v WHERE NOT (ed.size < 2 AND (x.e OR y.e OR ed.size < 0.05 * least(a.size, b.size)))")
def clean_edges(spark, d):
    e = edge_genomes(spark, d).where("u <> v").groupBy("u", "v").agg(F.count("*").alias("size"))
    n = genes(spark, d).groupBy("node").agg(F.countDistinct("genome").alias("size"), F.bool_or(F.col("pos") == 0).alias("has_end"))
    return G.clean_edges(e, n.withColumnRenamed("size", "node_size"), "node", "node_size", "has_end", 2).select("u", "v", "size")


@query("delete_node_reconnect", f"WITH {BOTH}, gone AS (SELECT 'view_3' AS n), ha AS (SELECT a, b, genome FROM two WHERE a IN (SELECT n FROM gone)) SELECT u, v, genome FROM em WHERE u NOT IN (SELECT n FROM gone) AND v NOT IN (SELECT n FROM gone) UNION SELECT x.b, y.b, x.genome FROM ha x JOIN ha y ON x.a = y.a AND x.genome = y.genome AND x.b < y.b AND x.b <> x.a AND y.b <> y.a")
def delete_node_reconnect(spark, d):
    e = edge_genomes(spark, d)
    return G.delete_nodes(e.where("not (u = v and u = 'view_3')"), spark.createDataFrame([("view_3",)], "node string"))


@query("remove_member", f"WITH {BOTH}, gone AS (SELECT DISTINCT node AS n, genome FROM genes WHERE node = 'click_5' AND genome < 50), ha AS (SELECT two.* FROM two JOIN gone ON n = a AND gone.genome = two.genome WHERE a <> b) SELECT u, v, genome FROM em WHERE NOT EXISTS (SELECT 1 FROM gone WHERE (n = u OR n = v) AND gone.genome = em.genome) UNION SELECT x.b, y.b, x.genome FROM ha x JOIN ha y ON x.a = y.a AND x.genome = y.genome AND x.b < y.b")
def remove_member(spark, d):
    gone = genes(spark, d).where("node = 'click_5' and genome < 50").select("node", "genome").distinct()
    return G.remove_members(edge_genomes(spark, d).where("not (u = v and u = 'click_5' and genome < 50)"), gone)


@query("merge_relabel", f"WITH {ADJ}, r AS (SELECT u, v, genome, split_part(u, '_', 1) || '_' || CAST(CAST(split_part(u, '_', 2) AS INT) % 7 AS VARCHAR) AS a, split_part(v, '_', 1) || '_' || CAST(CAST(split_part(v, '_', 2) AS INT) % 7 AS VARCHAR) AS b FROM em) SELECT DISTINCT least(a, b) AS u, greatest(a, b) AS v, genome FROM r WHERE a <> b")
def merge_relabel(spark, d):
    k = F.split("old", "_")
    relabel = genes(spark, d).select(F.col("node").alias("old")).distinct().withColumn("new", F.concat_ws("_", k[0], (k[1].cast("int") % 7).cast("string")))
    return G.merge_nodes(edge_genomes(spark, d), relabel)


@query("degree_branch", f"WITH {_EDGES} SELECT x AS node, count(*) AS degree FROM (SELECT unnest([u, v]) AS x FROM ed) GROUP BY x HAVING count(*) >= 3")
def degree_branch(spark, d):
    e = edge_genomes(spark, d).where("u <> v").select("u", "v").distinct()
    return G.degrees(e, "u", "v").where("degree >= 3")


@query("subgraph", f"WITH {_EDGES} SELECT u, v, size FROM ed WHERE u LIKE 'view%' AND v LIKE 'view%'")
def subgraph(spark, d):
    e = edge_genomes(spark, d).where("u <> v").groupBy("u", "v").agg(F.count("*").alias("size"))
    n = genes(spark, d).where("node like 'view%'").select("node").distinct()
    return G.subgraph(e, n, "node", "u", "v")


# ---- sequences

_TABLE = codons.residues_by_base4(11)
_MAP = "MAP {" + ", ".join(f"'{a + b + c}': '{_TABLE[16 * i + 4 * j + k]}'" for i, a in enumerate("ACGT") for j, b in enumerate("ACGT") for k, c in enumerate("ACGT")) + "}"


def _prot(seq: str, start: bool = True) -> str:
    raw = f"array_to_string(list_transform(range(0, length({seq}) // 3), lambda i: coalesce(({_MAP})[substr({seq}, i * 3 + 1, 3)], 'X')), '')"
    if not start:
        return raw
    starts = ", ".join(f"'{c}'" for c in codons.start_codons(11))
    return f"CASE WHEN substr({seq}, 1, 3) IN ({starts}) THEN 'M' || substr({raw}, 2) ELSE {raw} END"


def whole(seq: str = "seq"):
    return F.substring(seq, F.lit(1), F.length(seq) - F.length(seq) % 3)


_WHOLE = "substr(seq, 1, length(seq) - length(seq) % 3)"


@query("reverse_complement", f"WITH {DNA} SELECT doc_id, reverse(translate(seq, '{_FROM}', '{_TO}')) AS rc FROM dna")
def reverse_complement(spark, d):
    return dna(spark, d).select("doc_id", S.reverse_complement(F.col("seq")).alias("rc"))


@query("translate_codons", f"WITH {DNA}, w AS (SELECT doc_id, {_WHOLE} AS seq FROM dna) SELECT doc_id, {_prot('seq')} AS protein FROM w")
def translate_codons(spark, d):
    return dna(spark, d).select("doc_id", S.translate_codons(whole()).alias("protein"))


@query("translate_standard", f"WITH {DNA} SELECT doc_id, {_prot('seq', False)} AS protein FROM dna")
def translate_standard(spark, d):
    return dna(spark, d).select("doc_id", S.translate_standard(F.col("seq")).alias("protein"))


@query("is_valid_gene", f"WITH {DNA}, w AS (SELECT doc_id, seq, {_prot('seq', False)} AS p FROM dna) SELECT doc_id, CASE WHEN length(seq) % 3 <> 0 THEN false ELSE p LIKE 'M%' AND position('*' IN substr(p, 1, greatest(length(p) - 1, 0))) = 0 END AS valid FROM w WHERE p <> ''")
def is_valid_gene(spark, d):
    w = dna(spark, d).withColumn("p", S.translate_standard(F.col("seq"))).where("p <> ''")
    return w.select("doc_id", S.is_valid_gene(F.col("seq"), F.col("p")).alias("valid"))


@query("internal_stop", f"WITH {DNA}, w AS (SELECT doc_id, {_prot('seq', False)} AS p FROM dna) SELECT doc_id, position('*' IN substr(p, 2, greatest(length(p) - 4, 0))) > 0 AS internal_stop FROM w")
def internal_stop(spark, d):
    return dna(spark, d).select("doc_id", S.internal_stop(S.translate_standard(F.col("seq"))).alias("internal_stop"))


@query("gene_validity", f"WITH {DNA}, w AS (SELECT doc_id, seq, {_prot('seq', False)} AS p FROM dna) SELECT doc_id, CASE WHEN doc_id % 10 <> 0 AND doc_id % 7 = 0 THEN 'frame' WHEN length(seq) % 3 > 0 THEN 'length' WHEN length(seq) < 34 THEN 'short' WHEN position('*' IN substr(p, 1, greatest(length(p) - 1, 0))) > 0 THEN 'stop' END AS reason FROM w")
def gene_validity(spark, d):
    frame = F.when((F.col("doc_id") % 10 != 0) & (F.col("doc_id") % 7 == 0), "1").otherwise("0")
    return dna(spark, d).select("doc_id", S.invalid_reason(F.col("seq"), frame, S.translate_standard(F.col("seq"))).alias("reason"))


@query("kmer_shared", f"WITH {DNA}, h AS (SELECT doc_id, substr(seq, 1, length(seq) // 2) AS a, substr(seq, length(seq) // 2 + 1) AS b FROM dna) SELECT doc_id, CAST(len(list_intersect(list_distinct(list_transform(range(1, length(a) - 4), lambda i: substr(a, i, 5))), list_distinct(list_transform(range(1, length(b) - 3), lambda i: substr(b, i, 5))))) AS INTEGER) AS shared FROM h".replace("length(a) - 4", "greatest(length(a) - 3, 1)").replace("length(b) - 3)", "greatest(length(b) - 3, 1))"))
def kmer_shared(spark, d):
    half = F.floor(F.length("seq") / 2).cast("int")
    h = dna(spark, d).select("doc_id", F.substring("seq", F.lit(1), half).alias("a"), F.substring("seq", half + 1, F.length("seq")).alias("b"))
    return h.select("doc_id", S.shared_kmers(F.col("a"), F.col("b"), 5).alias("shared"))


@query("kmer_counts", f"WITH {DNA} SELECT doc_id, CAST(len(list_distinct(list_transform(range(1, greatest(length(seq) - 1, 1)), lambda i: substr(seq, i, 3)))) AS INTEGER) AS n_kmers FROM dna")
def kmer_counts(spark, d):
    return dna(spark, d).select("doc_id", F.size(S.kmers(F.col("seq"), 3)).alias("n_kmers"))


def _padded(seq: str, frame: int) -> str:
    s = f"substr({seq}, {frame + 1})"
    return f"({s} || repeat('N', CAST(3 - length({s}) % 3 AS INT)))"


_READ = "MAP {" + ", ".join(f"'{c}': '{r}'" for c, r in codons.ambiguous_codons(1).items() if set(c) <= set("ACGTN")) + "}"


@query("best_frame", f"""WITH {DNA}, both_ AS (SELECT doc_id, seq, reverse(translate(seq, 'ACGT', 'TGCA')) AS r FROM dna),
fr AS (SELECT doc_id, {", ".join(f"{_padded(s, f)} AS s{2 * f + k}" for f in range(3) for k, s in enumerate(("seq", "r")))} FROM both_),
un AS (SELECT doc_id, unnest(range(0, 6)) AS i, unnest([s0, s1, s2, s3, s4, s5]) AS s FROM fr),
pr AS (SELECT doc_id, i, array_to_string(list_transform(range(0, length(s) // 3), lambda k: coalesce(({_READ})[substr(s, k * 3 + 1, 3)], 'X')), '') AS p FROM un),
km AS (SELECT doc_id, i, p, list_distinct(list_transform(range(1, greatest(length(p) - 1, 1)), lambda k: substr(p, k, 3))) AS m FROM pr),
sc AS (SELECT a.doc_id, a.i, a.p, len(list_intersect(a.m, b.m)) AS n FROM km a JOIN km b ON a.doc_id = b.doc_id AND b.i = 3)
SELECT doc_id, p AS protein FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, i) AS k FROM sc) WHERE k = 1""")
def best_frame(spark, d):
    """Six frames against a protein made from the second frame of the other strand."""
    w = dna(spark, d)
    # the protein is a column of its own, so that it is made once
    return w.withColumn("target", S.padded_frame(S.reverse_complement(F.col("seq")), 1)).select("doc_id", S.best_frame(F.col("seq"), F.col("target")).alias("protein"))


@query("codon_qc", f"WITH {DNA}, w AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN replace(seq, 'CCA', 'CNN') WHEN doc_id % 5 = 1 THEN replace(seq, 'AAC', 'AAN') ELSE seq END AS seq FROM dna), x AS (SELECT doc_id, seq, {_prot(_WHOLE)} AS p FROM w) SELECT doc_id, array_to_string(list_filter([CASE WHEN length(seq) % 3 <> 0 THEN '0' END, CASE WHEN length(seq) % 3 = 0 AND regexp_replace(p, '\\*$', '') <> regexp_replace(replace(p, 'K', 'R'), '\\*$', '') THEN '1' END, CASE WHEN position('NN' IN seq) > 0 THEN '2' END, CASE WHEN list_has_any(list_transform(range(0, length(seq) // 3), lambda i: substr(seq, i * 3 + 1, 3)), {list(S.DEGENERATE_CODONS)}) THEN '3' END], lambda x: x IS NOT NULL), ',') AS failures FROM x")
def codon_qc(spark, d):
    s = F.when(F.col("doc_id") % 5 == 0, F.replace("seq", F.lit("CCA"), F.lit("CNN"))).when(F.col("doc_id") % 5 == 1, F.replace("seq", F.lit("AAC"), F.lit("AAN"))).otherwise(F.col("seq"))
    w = dna(spark, d).withColumn("seq", s).withColumn("p", F.replace(S.translate_codons(whole()), F.lit("K"), F.lit("R")))
    return w.select("doc_id", F.array_join(S.codon_failures(F.col("seq"), F.col("p")).cast("array<string>"), ",").alias("failures"))


@query("back_translate", f"WITH {DNA}, x AS (SELECT doc_id, seq, regexp_replace({_prot('seq', False)}, '([LR])', '-\\1', 'g') AS p FROM dna), c AS (SELECT doc_id, seq, unnest(string_split(p, '')) AS r, unnest(range(0, length(p))) AS i FROM x WHERE p <> ''), n AS (SELECT *, sum(CASE WHEN r = '-' THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM c), y AS (SELECT doc_id, string_agg(CASE WHEN r = '-' THEN '---' ELSE substr(seq, CAST(k * 3 - 2 AS BIGINT), 3) END, '' ORDER BY i) AS aligned FROM n GROUP BY doc_id) SELECT doc_id, coalesce(aligned, '') AS aligned FROM dna LEFT JOIN y USING (doc_id)")
def back_translate(spark, d):
    w = dna(spark, d).withColumn("p", F.regexp_replace(S.translate_standard(F.col("seq")), "([LR])", "-$1"))
    return w.select("doc_id", S.back_translate(F.col("p"), F.col("seq")).alias("aligned"))


_RUNS = "(substr(seq, 1, 50) || repeat('N', CAST(15 + doc_id % 12 AS INT)) || substr(seq, 51, 40) || repeat('N', CAST(18 + doc_id % 5 AS INT)) || substr(seq, 91))"


@query("n_run_mask", f"WITH {DNA}, w AS (SELECT doc_id, {_RUNS} AS db FROM dna), m AS (SELECT doc_id, db, regexp_extract(db, '^[ACGTEX]*N{{20}}') AS a, regexp_extract(db, 'N{{20}}[ACGTEX]*$') AS b FROM w) SELECT doc_id, repeat('X', CAST(length(a) AS INT)) || substr(db, CAST(length(a) + 1 AS BIGINT)) AS leading, substr(db, 1, CAST(length(db) - length(b) AS BIGINT)) || repeat('X', CAST(length(b) AS INT)) AS trailing FROM m")
def n_run_mask(spark, d):
    n = lambda a, m: F.repeat(F.lit("N"), (F.lit(a) + F.col("doc_id") % m).cast("int"))
    db = F.concat(F.substring("seq", 1, 50), n(15, 12), F.substring("seq", 51, 40), n(18, 5), F.substring("seq", F.lit(91), F.length("seq")))
    w = dna(spark, d).select("doc_id", db.alias("db"))
    return w.select("doc_id", S.mask_leading_run(F.col("db")).alias("leading"), S.mask_trailing_run(F.col("db")).alias("trailing"))


@query("trim_map", f"WITH {DNA}, w AS (SELECT doc_id, 'NEX' || replace(seq, 'CAT', 'XEX') || 'EN' AS s FROM dna) SELECT doc_id, translate(regexp_replace(regexp_replace(s, '^[NXE]+', ''), '[NXE]+$', ''), 'XE', 'NN') AS found, CAST(length(s) - length(replace(s, 'X', '')) AS INTEGER) AS n_x, CAST(length(regexp_replace(s, '[^ACGT]', '', 'g')) AS INTEGER) AS n_acgt FROM w")
def trim_map(spark, d):
    w = dna(spark, d).select("doc_id", F.concat(F.lit("NEX"), F.replace("seq", F.lit("CAT"), F.lit("XEX")), F.lit("EN")).alias("s"))
    return w.select("doc_id", S.trim_found(F.col("s")).alias("found"), S.letter_count(F.col("s"), "X").alias("n_x"), S.letter_count(F.col("s"), "ACGT").alias("n_acgt"))


@query("cigar_inserts", "WITH c AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS VARCHAR) || 'I' ELSE '' END || '5=2X3I9=' || CASE WHEN p_size % 2 = 0 THEN CAST(p_size + 1 AS VARCHAR) || 'I' ELSE '' END AS cigar FROM part) SELECT p_partkey, coalesce(TRY_CAST(regexp_extract(cigar, '^(\\d+)I', 1) AS BIGINT), 0) + coalesce(TRY_CAST(regexp_extract(cigar, '(\\d+)I$', 1) AS BIGINT), 0) AS inserts FROM c")
def cigar_inserts(spark, d):
    size = F.col("p_size")
    cigar = F.concat(F.when(size % 3 == 0, F.concat(size.cast("string"), F.lit("I"))).otherwise(""), F.lit("5=2X3I9="), F.when(size % 2 == 0, F.concat((size + 1).cast("string"), F.lit("I"))).otherwise(""))
    return table(spark, d, "part").select("p_partkey", S.terminal_inserts(cigar).alias("inserts"))


@query("sample_key", f"WITH {GENES} SELECT event_id, 'iso_' || genome || '_' || contig || '_' || pos AS seq_id, 'iso_' || genome AS sample FROM genes")
def sample_key(spark, d):
    g = genes(spark, d).select("event_id", F.concat_ws("_", F.lit("iso"), F.col("genome").cast("string"), "contig", F.col("pos").cast("string")).alias("seq_id"))
    return g.withColumn("sample", X.sample_key(F.col("seq_id")))


@query("floor_math", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(CAST(l_partkey - 500 AS DOUBLE) / l_linenumber) AS BIGINT) AS q, CAST(l_partkey - 500 - floor(CAST(l_partkey - 500 AS DOUBLE) / l_linenumber) * l_linenumber AS BIGINT) AS r, CAST(ceil(CAST(l_partkey AS DOUBLE) / 7) AS BIGINT) AS c FROM lineitem")
def floor_math(spark, d):
    a, b = F.col("l_partkey") - 500, F.col("l_linenumber")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", X.floor_div(a, b).alias("q"), X.floor_mod(a, b).alias("r"), F.ceil(F.col("l_partkey") / 7).cast("long").alias("c"))


# ---- alignments


def aligned(spark, d):
    """Whole texts as rows of an alignment: those of a source are padded with gaps to the longest."""
    a = dna(spark, d).join(table(spark, d, "documents").select("doc_id", F.col("source").alias("gene")), "doc_id")
    longest = a.groupBy("gene").agg(F.max(F.length("seq")).alias("len"))
    return a.join(F.broadcast(longest), "gene").select("gene", "doc_id", F.rpad(F.translate("seq", "G", "-"), F.col("len"), "-").alias("seq"))


_ALIGNED = DNA + """, al AS (SELECT source AS gene, dna.doc_id, translate(seq, 'G', '-') AS raw, max(length(seq)) OVER (PARTITION BY source) AS len FROM dna JOIN documents USING (doc_id)),
gn AS (SELECT gene, count(*) AS n FROM al GROUP BY 1), ch AS (SELECT gene, unnest(string_split(raw, '')) AS b, unnest(range(0, length(raw))) AS pos FROM al WHERE raw <> ''),
cn AS (SELECT gene, pos, count(*) FILTER (b = 'A') AS n_a, count(*) FILTER (b = 'C') AS n_c, count(*) FILTER (b = 'G') AS n_g, count(*) FILTER (b = 'T') AS n_t FROM ch GROUP BY 1, 2),
cc AS (SELECT *, n - n_a - n_c - n_g - n_t AS n_other FROM cn JOIN gn USING (gene)),
gaps AS (SELECT gene, doc_id, doc_id % 3 AS genome, len, rpad(raw, CAST(len AS INTEGER), '-') AS seq, len - length(replace(raw, '-', '')) AS gaps FROM al)"""
_H = " + ".join(f"CASE WHEN n_{b} > 0 THEN -(CAST(n_{b} AS DOUBLE) / n) * ln(CAST(n_{b} AS DOUBLE) / n) ELSE 0 END" for b in "acgt")
_ENTROPY = _ALIGNED + f", en AS (SELECT gene, sum((1 - CAST(n_other AS DOUBLE) / n) * ({_H})) / sum(1 - CAST(n_other AS DOUBLE) / n) AS entropy FROM cc GROUP BY gene)"


@query("column_counts", f"WITH {_ALIGNED} SELECT gene, CAST(pos AS INTEGER) AS pos, n_a, n_c, n_g, n_t, n_other FROM cc")
def column_counts(spark, d):
    return A.column_counts(aligned(spark, d), "gene", "seq")


@query("weighted_entropy", f"WITH {_ENTROPY} SELECT gene, round(entropy, 9) AS entropy FROM en")
def weighted_entropy(spark, d):
    return A.weighted_entropy(A.column_counts(aligned(spark, d), "gene", "seq"), "gene").withColumn("entropy", F.round("entropy", 9))


@query("entropy_threshold", f"WITH {_ENTROPY}, r AS (SELECT round(entropy, 9) AS e FROM en), q AS (SELECT quantile_cont(e, 0.25) AS q1, quantile_cont(e, 0.75) AS q3 FROM r) SELECT round(q1, 7) AS q1, round(q3, 7) AS q3, round(greatest(0.01, q3 + 1.5 * (q3 - q1)), 7) AS threshold FROM q")
def entropy_threshold(spark, d):
    t = A.entropy_threshold(weighted_entropy(spark, d))
    return t.select(*(F.round(c, 7).alias(c) for c in t.columns))


@query("least_gapped", f"WITH {_ALIGNED} SELECT gene, genome, doc_id FROM (SELECT gene, doc_id % 3 AS genome, doc_id, row_number() OVER (PARTITION BY gene, doc_id % 3 ORDER BY gaps, doc_id) AS r FROM gaps) WHERE r = 1")
def least_gapped(spark, d):
    return A.least_gapped(aligned(spark, d).withColumn("genome", F.col("doc_id") % 3), "gene", "genome", "seq", "doc_id").select("gene", "genome", "doc_id")


@query("equal_lengths", f"WITH {_ALIGNED} SELECT gene, count(*) AS n, count(DISTINCT length(seq)) AS lengths FROM gaps GROUP BY gene")
def equal_lengths(spark, d):
    return A.checked(aligned(spark, d), "gene", "seq").groupBy("gene").agg(F.count("*").alias("n"), F.countDistinct(F.length("seq")).alias("lengths"))


@query("core_concat", f"WITH {_ALIGNED}, m AS (SELECT gene, genome, seq FROM (SELECT *, row_number() OVER (PARTITION BY gene, genome ORDER BY gaps, doc_id) AS r FROM gaps) WHERE r = 1), g AS (SELECT gene, max(len) AS len FROM al GROUP BY 1), i AS (SELECT unnest([0, 1, 2]) AS genome) SELECT CAST(i.genome AS BIGINT) AS genome, string_agg(coalesce(m.seq, repeat('-', CAST(g.len AS INTEGER))), '' ORDER BY g.gene) AS seq FROM i CROSS JOIN g LEFT JOIN m ON m.gene = g.gene AND m.genome = i.genome GROUP BY i.genome")
def core_concat(spark, d):
    best = A.least_gapped(aligned(spark, d).withColumn("genome", F.col("doc_id") % 3), "gene", "genome", "seq", "doc_id")
    g = best.groupBy("gene").agg(F.max(F.length("seq")).alias("length"))
    return A.concatenated(R.gap_filled(spark.range(3).toDF("genome"), g, best, "genome", "gene", "seq", "length"), "genome", "seq", "gene")


# ---- text


@query("attribute_parse", "SELECT page_id, 'ID=p' || page_id || ';note=' || replace(url, '.', '|') || '|x y;flag=' AS parsed FROM pages")
def attribute_parse(spark, d):
    """Column nine made from parts and pages: split raw, unquote, decode, repeated keys add up."""
    p = table(spark, d, "pages")
    field = F.concat(F.lit("ID=p"), F.col("page_id").cast("string"), F.lit(";note="), F.replace(F.replace("url", F.lit("/"), F.lit("%2F")), F.lit("."), F.lit(",")), F.lit(';note="x%20y";flag;'))
    a = X.attributes(field)
    return p.select("page_id", F.array_join(F.transform(a, lambda x: F.concat(x["key"], F.lit("="), F.array_join(x["values"], "|"))), ";").alias("parsed"))


@query("percent_decode", "SELECT page_id, url_decode(replace(replace(url, '/', '%2F'), 'e', '%65')) AS decoded FROM pages")
def percent_decode(spark, d):
    e = F.replace(F.replace("url", F.lit("/"), F.lit("%2F")), F.lit("e"), F.lit("%65"))
    return table(spark, d, "pages").select("page_id", X.percent_decode(e).alias("decoded"))


@query("gene_name_clean", "SELECT p_partkey, regexp_replace(array_to_string(list_filter(string_split(';' || p_name || ';;' || p_brand || ';', ';'), lambda x: x <> ''), '~~~'), '[^A-Za-z0-9_~]', '', 'g') AS name FROM part")
def gene_name_clean(spark, d):
    return table(spark, d, "part").select("p_partkey", X.clean_gene_name(F.concat(F.lit(";"), "p_name", F.lit(";;"), "p_brand", F.lit(";"))).alias("name"))


@query("wrap60", f"WITH {DNA} SELECT doc_id, array_to_string(list_transform(range(0, (length(seq) + 59) // 60), lambda i: substr(seq, i * 60 + 1, 60)), chr(10)) AS wrapped FROM dna")
def wrap60(spark, d):
    return dna(spark, d).select("doc_id", X.wrap(F.col("seq")).alias("wrapped"))


@query("file_stem", "SELECT page_id, regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*?)(\\.[^./]*)?$', 1) AS stem FROM pages")
def file_stem(spark, d):
    return table(spark, d, "pages").select("page_id", X.stem(F.regexp_replace("url", "[?#].*$", "")).alias("stem"))


# ---- similarity (tested against plain models)


@query("similar_pairs", None)
def similar_pairs(spark, d):
    rows = dna(spark, d).join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return C.similar_pairs(rows, ["source"], "doc_id", "seq", 0.98, True).select("a", "b", F.round("identity", 6).alias("identity"))


@query("greedy_clusters", None)
def greedy_clusters(spark, d):
    return C.greedy_clusters(dna(spark, d), "doc_id", "seq", 0.98, True, 7, 0.98)


@query("iterative_clusters", None)
def iterative_clusters(spark, d):
    return C.iterative_clusters(dna(spark, d), "doc_id", "seq", True, len_dif=0.98)


def family_nodes(spark, d):
    """Nodes of the events lens with a number, their genomes and a centroid for each type."""
    g = genes(spark, d)
    n = g.groupBy("node").agg(F.countDistinct("genome").alias("size"), F.array_sort(F.collect_set("genome")).alias("members"), F.min("event_id").alias("first"))
    n = P.numbered(n, ["first"], 0, "id").select(F.col("id").alias("node"), F.col("node").alias("name"), "size", "members")
    c = F.concat(F.lit("c"), F.col("node").cast("string"))
    n = n.withColumn("centroids", F.array(c)).withColumn("genes", F.transform("members", lambda m: F.struct(m.alias("genome"), c.alias("centroid"))))
    e = edge_genomes(spark, d).where("u <> v")
    ids = n.select("name", "node")
    e = e.join(ids.toDF("u", "a"), "u").join(ids.toDF("v", "b"), "v").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"), "genome")
    return n, e


@query("family_collapse", None)
def family_collapse(spark, d):
    from strandloom.operators.families import collapse_families

    n, e = family_nodes(spark, d)
    t = n.select(F.split("name", "_")[0].alias("t"), F.element_at("centroids", 1).alias("c"), "node")
    near = t.alias("x").join(t.alias("y"), (F.col("x.t") == F.col("y.t")) & (F.col("y.node") == F.col("x.node") + 5)).select(F.col("x.c").alias("a"), F.col("y.c").alias("b"))
    return collapse_families(n.drop("name"), e, near)


@query("greedy_coverage", None)
def greedy_coverage(spark, d):
    s = spans(spark, d).withColumn("m", F.col("e") - F.col("s"))
    return R.greedy_coverage(s, ["g"], "id", ["m desc", "id desc", "s"], "s", "e", "m").select("g", "id", "s", "covered", "kept")
