"""Registered queries over the driver's tables and the SQL that each must equal.

The tables stand in for the corpus: each query runs one operator of the library on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, ordering, refs, tags, text
from ..operators import builders, curation, quality, retrieval
from ..operators.embedding import HashEmbedder, embed_texts
from ..schemas import BOOKS, RULE_BOOKS
from ..scratch import staged, tasks_of
from ..sinks import jsonl

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
Read = Callable[[str], DataFrame]


def query(name: str, sql: str | None = None):
    def register(make: Callable[[Read], DataFrame]) -> Callable[[Read], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: make(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql is not None:
            ORACLES[name] = sql
        return make

    return register


def long(value: Column) -> Column:
    return value.cast("long")


# --- retrieval -------------------------------------------------------------------------------------

#: The query vector of the vector queries: row 7's.
AT, TOP = 7, 10


def _vector(t: Read) -> list[float]:
    row = t("embeddings").filter(F.col("vec_id") == AT).select("embedding").first()
    return list(row["embedding"])


def _nearest(t: Read, rows: DataFrame, keep: Column | None = None) -> DataFrame:
    found = retrieval.nearest(rows, "embedding", _vector(t), TOP, ("vec_id",), keep)
    return found.select("vec_id", F.round("distance", 6).alias("distance"))


_DISTANCE = f"list_cosine_distance(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = {AT}))"


@query("vector_topk", f"SELECT vec_id, round(d, 6) AS distance FROM (SELECT vec_id, {_DISTANCE} AS d FROM embeddings) ORDER BY d, vec_id LIMIT {TOP}")
def vector_topk(t: Read) -> DataFrame:
    return _nearest(t, t("embeddings"))


@query("vector_topk_filtered", f"SELECT vec_id, round(d, 6) AS distance FROM (SELECT vec_id, {_DISTANCE} AS d FROM embeddings WHERE label IN (1, 2, 3)) ORDER BY d, vec_id LIMIT {TOP}")
def vector_topk_filtered(t: Read) -> DataFrame:
    """Levels stand for labels: the hard filter comes before ranking."""
    rows = t("embeddings").withColumn("levels", F.array("label"))
    return _nearest(t, rows, retrieval.may_see(F.col("levels"), [1, 2, 3]))


@query("vector_topk_ties", f"SELECT vec_id, round(d, 6) AS distance FROM (SELECT vec_id, {_DISTANCE} AS d FROM embeddings UNION ALL SELECT vec_id + 1000000, {_DISTANCE} FROM embeddings) ORDER BY d, vec_id LIMIT {TOP}")
def vector_topk_ties(t: Read) -> DataFrame:
    rows = t("embeddings").select("vec_id", "embedding")
    return _nearest(t, rows.union(rows.select(F.col("vec_id") + 1_000_000, "embedding")))


@query("vector_norms", "SELECT vec_id, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm, len(embedding)::INTEGER AS dims FROM embeddings")
def vector_norms(t: Read) -> DataFrame:
    return t("embeddings").select("vec_id", F.round(retrieval.norm(F.col("embedding")), 6).alias("norm"), F.size("embedding").alias("dims"))


def _edges(t: Read) -> DataFrame:
    return t("lineitem").select(F.col("l_suppkey").alias("sourceId"), ((F.col("l_suppkey") + F.col("l_linenumber")) % 100 + 1).alias("targetId"), F.lit("tsk").alias("kind")).distinct()


_EDGES = "edges AS (SELECT DISTINCT l_suppkey AS s, (l_suppkey + l_linenumber) % 100 + 1 AS t FROM lineitem)"


def _walk_sql(hops: int, allowed: str = "true") -> str:
    return f"""WITH RECURSIVE {_EDGES}, w AS (
      SELECT 1 AS depth, s, t, [s, t] AS path FROM edges WHERE s = 7 AND t <> s AND {allowed}
      UNION ALL SELECT depth + 1, e.s, e.t, list_append(path, e.t) FROM w JOIN edges e ON e.s = w.t WHERE depth < {hops} AND NOT list_contains(path, e.t) AND {allowed.replace('t ', 'e.t ') if allowed != 'true' else 'true'}
    ) SELECT min(depth)::INTEGER AS depth, s AS source, t AS target, 'tsk' AS kind FROM w GROUP BY s, t"""


for _hops in (1, 2, 3):

    @query(f"cross_refs_{_hops}hop", _walk_sql(_hops))
    def cross_refs(t: Read, hops: int = _hops) -> DataFrame:
        return retrieval.walk(_edges(t), 7, hops)


@query("cross_refs_no_leak", _walk_sql(3, "t IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 4 <> 1)"))
def cross_refs_no_leak(t: Read) -> DataFrame:
    """Nodes that may not be seen are closed at every hop."""
    return retrieval.walk(_edges(t), 7, 3, allowed=t("supplier").filter("s_suppkey % 4 <> 1").select("s_suppkey"))


@query("exegesis_lookup", """SELECT o_orderkey, coalesce(string_agg(l_linenumber || ':' || l_partkey || ':' || l_suppkey || ':' || coalesce(p_brand, '-'), ',' ORDER BY l_linenumber, l_partkey, l_suppkey, p_brand), '') AS words
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN (SELECT * FROM part WHERE p_size < 25) ON p_partkey = l_partkey GROUP BY o_orderkey""")
def exegesis_lookup(t: Read) -> DataFrame:
    """Records with their children; a child without an entry stays."""
    entries = t("part").filter("p_size < 25").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    n = tasks_of(t("lineitem"))
    keys = t("orders").select("o_orderkey").repartition(n, "o_orderkey")
    words = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").repartition(n, "l_partkey").join(entries.repartition(n, "l_partkey"), "l_partkey", "left").repartition(n, "l_orderkey")
    found = retrieval.children(keys, "o_orderkey", words.join(keys, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi"), "l_orderkey", ("l_linenumber", "l_partkey", "l_suppkey", "p_brand"), "w")
    shown = F.transform("w", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"), x["l_suppkey"].cast("string"), F.coalesce(x["p_brand"], F.lit("-"))))
    return found.select("o_orderkey", F.array_join(shown, ",").alias("words"))


@query("passage_search", f"""WITH p AS (SELECT vec_id, {_DISTANCE} AS d FROM embeddings ORDER BY d, vec_id LIMIT 5)
  SELECT vec_id AS passage, n_nationkey AS verse FROM p JOIN nation ON n_nationkey BETWEEN vec_id % 20 AND vec_id % 20 + 4""")
def passage_search(t: Read) -> DataFrame:
    """Nearest passages written out into the verses between their ends."""
    start = (F.col("vec_id") % 20).cast("int")
    passages = t("embeddings").select(F.col("vec_id").alias("passageId"), "embedding", F.lit("GEN").alias("book"), F.lit(1).alias("chapter"), start.alias("verseStart"), (start + 4).alias("verseEnd"))
    verses = t("nation").select(F.col("n_nationkey").alias("id"), F.lit("GEN").alias("book"), F.lit(1).alias("chapter"), F.col("n_nationkey").alias("verse"))
    return retrieval.search_passages(passages, verses, _vector(t), 5).select(F.col("passageId").alias("passage"), F.col("canonicalId").alias("verse"))


@query("retrieval_eval", """WITH g AS (SELECT r_regionkey AS id FROM region), f AS (SELECT n_regionkey AS id, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS rank FROM nation)
  SELECT g.id, bool_or(f.n_name = 'NATION_' || (g.id + 5)) AS covered, bool_or(f.rank = 1 AND f.n_name = 'NATION_' || (g.id + 5)) AS strict FROM g JOIN f USING (id) GROUP BY g.id""")
def retrieval_eval(t: Read) -> DataFrame:
    golden = t("region").select(F.col("r_regionkey").alias("id"), F.array(F.concat(F.lit("NATION_"), (F.col("r_regionkey") + 5).cast("string"))).alias("expectedIds"))
    got = ordering.dense_position(t("nation"), "n_regionkey", "n_nationkey", out="rank").select(F.col("n_regionkey").alias("id"), "rank", F.col("n_name").alias("canonicalId"))
    return retrieval.evaluate(golden, got)


# --- integrity -------------------------------------------------------------------------------------


@query("fk_orphans", """SELECT 'labels' AS child, doc_id AS ref FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)
  UNION ALL SELECT 'lineitem', k FROM (SELECT l_orderkey AS k FROM lineitem EXCEPT SELECT o_orderkey FROM orders)
  UNION ALL SELECT 'documents', d FROM (SELECT doc_id AS d FROM documents EXCEPT SELECT doc_id FROM labels)""")
def fk_orphans(t: Read) -> DataFrame:
    parts = (("labels", "doc_id", "documents", "doc_id"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("documents", "doc_id", "labels", "doc_id"))
    found = [quality.orphans(t(child), column, t(parent), key).select(F.lit(child).alias("child"), "ref") for child, column, parent, key in parts]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("join_completeness", """SELECT doc_id, 'missing' AS side FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
  UNION ALL SELECT doc_id, 'orphan' FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)""")
def join_completeness(t: Read) -> DataFrame:
    return quality.completeness(t("documents"), t("labels"), ["doc_id"])


@query("left_join_fallback", "SELECT d.doc_id, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN labels l USING (doc_id)")
def left_join_fallback(t: Read) -> DataFrame:
    return t("documents").select("doc_id").join(t("labels").select("doc_id", "quality"), "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"))


@query("pk_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def pk_duplicates(t: Read) -> DataFrame:
    return quality.duplicates(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("row_rule_violations", """SELECT 'quantity is small' AS rule, count(*) AS count FROM lineitem WHERE NOT l_quantity <= 45 UNION ALL
  SELECT 'discount is small', count(*) FROM lineitem WHERE NOT l_discount < 0.09""")
def row_rule_violations(t: Read) -> DataFrame:
    rules = {"quantity is small": F.col("l_quantity") <= 45, "discount is small": F.col("l_discount") < 0.09}
    return quality.violations(t("lineitem").select("l_orderkey", "l_quantity", "l_discount"), rules).select("rule", "count")


@query("drop_rate", "SELECT count(*) AS attempted, count(*) FILTER (l.doc_id IS NULL) AS dropped, round(count(*) FILTER (l.doc_id IS NULL) / count(*), 6) AS rate FROM documents d LEFT JOIN labels l USING (doc_id)")
def drop_rate(t: Read) -> DataFrame:
    marked = t("documents").select("doc_id").join(t("labels").select("doc_id", F.lit(1).alias("kept")), "doc_id", "left")
    counts = marked.agg(F.count(F.lit(1)).alias("attempted"), F.count_if(F.col("kept").isNull()).alias("dropped"))
    return counts.withColumn("rate", F.round(quality.drop_rate(F.col("dropped"), F.col("attempted")), 6))


@query("vocab_violations", "SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'signup', 'purchase') GROUP BY event_type")
def vocab_violations(t: Read) -> DataFrame:
    return t("events").filter(~F.col("event_type").isin("view", "signup", "purchase")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("set_difference", """SELECT doc_id, 'left' AS side FROM (SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels)
  UNION ALL SELECT doc_id, 'right' FROM (SELECT doc_id FROM labels EXCEPT ALL SELECT doc_id FROM documents)""")
def set_difference(t: Read) -> DataFrame:
    return quality.set_difference(t("documents").select("doc_id"), t("labels").select("doc_id"))


@query("subset_check", "SELECT lang, bool_and(l.doc_id IS NOT NULL) AS covered, count(*) FILTER (l.doc_id IS NULL) AS lacking FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY lang")
def subset_check(t: Read) -> DataFrame:
    marked = t("documents").select("doc_id", "lang").join(t("labels").select("doc_id", F.lit(True).alias("has")), "doc_id", "left")
    return marked.groupBy("lang").agg(F.bool_and(F.coalesce("has", F.lit(False))).alias("covered"), F.count_if(F.col("has").isNull()).alias("lacking"))


@query("mapping_differences", """WITH a AS (SELECT o_custkey AS k, list_sort(list(DISTINCT o_orderstatus)) AS x FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), b AS (SELECT o_custkey AS k, list_sort(list(DISTINCT o_orderstatus)) AS x FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1)
  SELECT coalesce(a.k, b.k) AS k, coalesce(array_to_string(a.x, ','), '-') AS l, coalesce(array_to_string(b.x, ','), '-') AS r FROM a FULL JOIN b ON a.k = b.k WHERE a.x IS DISTINCT FROM b.x""")
def mapping_differences(t: Read) -> DataFrame:
    """Two mappings by key, compared as sets."""
    side = lambda odd, out: t("orders").filter(f"o_orderkey % 2 = {odd}").groupBy(F.col("o_custkey").alias("k")).agg(F.array_sort(F.collect_set("o_orderstatus")).alias(out))
    both = side(0, "a").join(side(1, "b"), "k", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
    return both.select("k", F.coalesce(F.array_join("a", ","), F.lit("-")).alias("l"), F.coalesce(F.array_join("b", ","), F.lit("-")).alias("r"))


# --- edges and ranges ------------------------------------------------------------------------------


@query("range_expand_intra", "SELECT n_nationkey AS source, unnest(range(n_regionkey + 1, n_regionkey + n_nationkey % 4 + 2))::INTEGER AS target FROM nation")
def range_expand_intra(t: Read) -> DataFrame:
    return t("nation").select(F.col("n_nationkey").alias("source"), F.explode(F.sequence(F.col("n_regionkey") + 1, F.col("n_regionkey") + F.col("n_nationkey") % 4 + 1)).alias("target"))


def _inventory(t: Read) -> DataFrame:
    """Parts as verses: fifty chapters to a book, ten verses to a chapter, and ten more each time that all books are full."""
    book = F.element_at(F.array(*[F.lit(b) for b in BOOKS]), (F.floor(F.col("p_partkey") / 500) % 66 + 1).cast("int"))
    chapter, verse = (F.floor(F.col("p_partkey") / 10) % 50 + 1).cast("int"), (F.col("p_partkey") % 10 + F.floor(F.col("p_partkey") / 33000) * 10).cast("int")
    return t("part").select("p_partkey", book.alias("book"), chapter.alias("chapter"), verse.alias("verse")).withColumn("id", ids.make_id(F.col("book"), F.col("chapter"), F.col("verse")))


_BOOKS = "[" + ", ".join(f"'{b}'" for b in BOOKS) + "]"
_INVENTORY = f"""inventory AS (SELECT k, book || '_' || c || '_' || v AS id, o * 1000000 + c * 1000 + v AS rk FROM (SELECT p_partkey AS k, {_BOOKS}[(p_partkey // 500) % 66 + 1] AS book, (p_partkey // 500) % 66 AS o, (p_partkey // 10) % 50 + 1 AS c, p_partkey % 10 + p_partkey // 33000 * 10 AS v FROM part))"""


@query("range_join_inventory", f"WITH {_INVENTORY} SELECT a.id AS source, v.id AS target FROM inventory a JOIN inventory b ON b.k = a.k + 23 JOIN inventory v ON v.rk BETWEEN a.rk AND b.rk WHERE a.rk <= b.rk")
def range_join_inventory(t: Read) -> DataFrame:
    inventory = _inventory(t)
    ends = inventory.select((F.col("p_partkey") - 23).alias("p_partkey"), F.col("id").alias("endId"))
    ranges = inventory.select("p_partkey", F.col("id").alias("sourceId"), F.col("id").alias("startId")).join(ends, "p_partkey")
    ranges = ranges.filter(ids.id_key(F.col("startId")) <= ids.id_key(F.col("endId")))
    return builders.expand_ranges(ranges.select("sourceId", "startId", "endId"), inventory).select(F.col("sourceId").alias("source"), F.col("targetId").alias("target"))


@query("edge_build_stats", f"""WITH {_INVENTORY}, c AS (SELECT DISTINCT l_partkey % 400 AS s, CASE WHEN l_linenumber = 1 THEN l_partkey % 400 ELSE (l_partkey + l_suppkey) % 4000 END AS t FROM lineitem),
  m AS (SELECT CASE WHEN a.id IS NULL OR b.id IS NULL THEN 'outside' WHEN s = t THEN 'loop' ELSE 'kept' END AS class FROM c LEFT JOIN inventory a ON a.k = s LEFT JOIN inventory b ON b.k = t)
  SELECT class, count(*) AS n FROM m GROUP BY class""")
def edge_build_stats(t: Read) -> DataFrame:
    inventory = _inventory(t)
    name = lambda k: F.concat_ws("_", F.element_at(F.array(*[F.lit(b) for b in BOOKS]), (F.floor(k / 500) % 66 + 1).cast("int")), (F.floor(k / 10) % 50 + 1).cast("string"), (k % 10 + F.floor(k / 33000) * 10).cast("string"))
    source = F.col("l_partkey") % 400
    target = F.when(F.col("l_linenumber") == 1, source).otherwise((F.col("l_partkey") + F.col("l_suppkey")) % 4000)
    direct = t("lineitem").select(name(source).alias("sourceId"), name(target).alias("targetId")).distinct()
    none = inventory.limit(0).select(F.col("id").alias("sourceId"), F.col("id").alias("startId"), F.col("id").alias("endId"))
    _, stats = builders.edges(direct, none, inventory, ceiling=1.0)
    rows = [(k, v) for k, v in (("outside", stats["discarded"]), ("loop", stats["self_loops"]), ("kept", stats["final"])) if v]
    return direct.sparkSession.createDataFrame(rows, "class string, n long")


@query("edge_centrality", f"WITH {_EDGES} SELECT s AS node, count(*) AS degree FROM edges GROUP BY s")
def edge_centrality(t: Read) -> DataFrame:
    return curation.centrality(_edges(t))


# --- order, sequence, serialisation ----------------------------------------------------------------

_LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("dense_position", "SELECT l_orderkey, l_partkey, l_suppkey, round(l_extendedprice, 2) AS price, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS position FROM lineitem")
def dense_position(t: Read) -> DataFrame:
    placed = ordering.dense_position(t("lineitem"), "l_orderkey", *_LINE)
    return placed.select("l_orderkey", "l_partkey", "l_suppkey", F.round("l_extendedprice", 2).alias("price"), long(F.col("position")).alias("position"))


@query("first_appearance_order", "SELECT event_type, min(event_id) AS first_place, row_number() OVER (ORDER BY min(event_id)) AS place FROM events GROUP BY event_type")
def first_appearance_order(t: Read) -> DataFrame:
    found = t("events").groupBy("event_type").agg(F.min("event_id").alias("first_place"))
    return ordering.global_position(found, "first_place", out="place").select("event_type", "first_place", long(F.col("place")).alias("place"))


@query("canonical_sort_rank", "SELECT event_id, row_number() OVER (ORDER BY CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END, user_id, event_id) AS rank FROM events")
def canonical_sort_rank(t: Read) -> DataFrame:
    rank = F.coalesce(ordering.by_rank(F.col("event_type"), ("signup", "view", "click", "purchase")), F.lit(4))
    placed = ordering.global_position(t("events").withColumn("kind", rank), "kind", "user_id", "event_id", out="rank")
    return placed.select("event_id", long(F.col("rank")).alias("rank"))


@query("reference_order", f"WITH {_INVENTORY} SELECT id, row_number() OVER (ORDER BY rk) AS place FROM inventory")
def reference_order(t: Read) -> DataFrame:
    rows = _inventory(t).withColumn("at", ids.id_key(F.col("id")))
    return ordering.global_position(rows, "at", out="place").select("id", long(F.col("place")).alias("place"))


_NATION_JSON = """'{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || ',"note":null}'"""


def _nation_lines(t: Read) -> DataFrame:
    rows = t("nation").withColumn("note", F.lit(None).cast("string"))
    return rows.select("n_nationkey", jsonl.json_line(rows, ["n_nationkey", "n_name", "n_regionkey", "note"]).alias("line"))


@query("jsonl_lines", f"SELECT n_nationkey, md5({_NATION_JSON}) AS hash FROM nation")
def jsonl_lines(t: Read) -> DataFrame:
    return _nation_lines(t).select("n_nationkey", F.md5("line").alias("hash"))


@query("table_sha256", f"SELECT sha256(string_agg({_NATION_JSON}, chr(10) ORDER BY n_nationkey) || chr(10)) AS sha256 FROM nation")
def table_sha256(t: Read) -> DataFrame:
    """The hash of a small reference table's file."""
    rows = _nation_lines(t).agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "line"))).alias("rows"))
    return rows.select(F.sha2(F.concat(F.array_join(F.transform("rows", lambda r: r["line"]), "\n"), F.lit("\n")), 256).alias("sha256"))


@query("set_array_canonical", "SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY user_id")
def set_array_canonical(t: Read) -> DataFrame:
    return t("events").groupBy("user_id").agg(F.array_join(text.set_array(F.collect_set("event_type")), ",").alias("kinds"))


@query("verse_sizes", """WITH w AS (SELECT l_suppkey % 10 AS b, l_linenumber AS c, l_quantity::INTEGER % 7 AS v, l_orderkey * 1000000 + l_partkey AS line FROM lineitem), g AS (SELECT b, c, v, count(*) AS words, min(line) AS first_line FROM w GROUP BY ALL)
  SELECT 'B' || b AS book, c AS chapter, v AS verse, words, v = 0 AS has_title, first_line, min(first_line) OVER (PARTITION BY b) AS book_first FROM g""")
def verse_sizes(t: Read) -> DataFrame:
    """Words per verse, with books by first appearance; line items stand for word lines."""
    from ..sources.tabular import verse_sizes as sizes

    ref = F.struct(F.concat(F.lit("B"), (F.col("l_suppkey") % 10).cast("string")).alias("book"), F.lit("known").alias("status"), F.col("l_linenumber").alias("chapter"), (F.col("l_quantity").cast("int") % 7).alias("verse"))
    return sizes(t("lineitem").select((F.col("l_orderkey") * 1_000_000 + F.col("l_partkey")).alias("line_no"), ref.alias("ref")))


@query("partition_counts", "SELECT lang, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last FROM documents GROUP BY lang")
def partition_counts(t: Read) -> DataFrame:
    return t("documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


@query("manifest_counts", "SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL SELECT 'labels', count(*) FROM labels UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'lang ' || lang, count(*) FROM documents GROUP BY lang")
def manifest_counts(t: Read) -> DataFrame:
    n = F.count(F.lit(1)).alias("n")
    out = t("documents").groupBy(F.concat(F.lit("lang "), "lang").alias("name")).agg(n)
    for name in ("documents", "labels", "events"):
        out = out.unionByName(t(name).agg(n).select(F.lit(name).alias("name"), "n"))
    return out


@query("jsonl_roundtrip", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def jsonl_roundtrip(t: Read) -> DataFrame:
    """Rows written as lines and parsed again with their schema."""
    return _nation_lines(t).select(F.from_json("line", "n_nationkey int, n_name string, n_regionkey int, note string", {"mode": "FAILFAST"}).alias("r")).select("r.n_nationkey", "r.n_name", "r.n_regionkey")


# --- scalar functions ------------------------------------------------------------------------------


@query("whitespace_word_count", r"SELECT doc_id, CASE WHEN c = '' THEN 0 ELSE len(string_split(c, ' ')) END AS words, md5(c) AS clean FROM (SELECT doc_id, trim(regexp_replace(text, '[\s\x0b\x{A0}\x{FEFF}\x{2028}\x{2029}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) AS c FROM documents)")
def whitespace_word_count(t: Read) -> DataFrame:
    return t("documents").select("doc_id", long(text.word_count(F.col("text"))).alias("words"), F.md5(text.collapse(F.col("text"))).alias("clean"))


@query("id_roundtrip", f"WITH {_INVENTORY} SELECT id, split_part(id, '_', 1) AS book, split_part(id, '_', 2)::INTEGER AS chapter, split_part(id, '_', 3)::INTEGER AS verse, rk::BIGINT AS ref_key, 'H' || lpad((k % 9999 + 1)::VARCHAR, 4, '0') AS entry FROM inventory")
def id_roundtrip(t: Read) -> DataFrame:
    ref = ids.parse_id(F.col("id"))
    return _inventory(t).select("id", ref["book"].alias("book"), ref["chapter"].alias("chapter"), ref["verse"].alias("verse"), ids.id_key(F.col("id")).alias("ref_key"), ids.lexicon_id(F.lit("H"), (F.col("p_partkey") % 9999 + 1).cast("string")).alias("entry"))


@query("id_validity", "SELECT o_orderkey, o_orderkey % 3 <> 0 AND o_custkey < 1000 AS valid FROM orders")
def id_validity(t: Read) -> DataFrame:
    book = F.when(F.col("o_orderkey") % 3 == 0, "XXX").otherwise("GEN")
    return t("orders").select("o_orderkey", ids.valid_id(F.concat_ws("_", book, F.col("o_custkey").cast("string"), F.lit("1"))).alias("valid"))


@query("book_translation", """SELECT n_nationkey, ['GEN', 'EXO', NULL, NULL][n_nationkey % 4 + 1] AS book, ['known', 'known', 'excluded', 'unknown'][n_nationkey % 4 + 1] AS status FROM nation""")
def book_translation(t: Read) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(x) for x in ("Gen", "Exod", "Tob", "Zzz")]), F.col("n_nationkey") % 4 + 1)
    found = ids.xref_book(code)
    return t("nation").select("n_nationkey", found["book"].alias("book"), found["status"].alias("status"))


@query("tag_classify", """WITH x AS (SELECT p_partkey, p_partkey % 5 AS m, lpad((p_partkey % 8999 + 1)::VARCHAR, 4, '0') AS n FROM part)
  SELECT p_partkey, CASE WHEN m IN (0, 1) THEN 'H' || n END AS root, CASE m WHEN 2 THEN 'roots' WHEN 3 THEN 'language' END AS error FROM x""")
def tag_classify(t: Read) -> DataFrame:
    n = F.lpad((F.col("p_partkey") % 8999 + 1).cast("string"), 4, "0")
    made = (
        F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("H9003/{H"), n, F.lit("A}"))).when(F.col("p_partkey") % 5 == 1, F.concat(F.lit("{H"), n, F.lit("}")))
        .when(F.col("p_partkey") % 5 == 2, F.concat(F.lit("H"), n, F.lit("/H0001"))).when(F.col("p_partkey") % 5 == 3, F.concat(F.lit("G"), n)).otherwise("H9001/H9002")
    )
    found = tags.classify(made, F.lit("H"))
    return t("part").select("p_partkey", found["root"].alias("root"), found["error"].alias("error"))


@query("composite_tags", """SELECT p_partkey, 'H' || lpad((p_partkey % 8999 + 1)::VARCHAR, 4, '0') AS root, CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 1 END AS roots FROM part""")
def composite_tags(t: Read) -> DataFrame:
    n = F.lpad((F.col("p_partkey") % 8999 + 1).cast("string"), 4, "0")
    found = tags.hebrew_roots(F.concat(F.lit("h9003/h"), n, F.lit("+"), F.when(F.col("p_partkey") % 2 == 0, "/H0002").otherwise(""), F.lit("\\\\H9014")))
    return t("part").select("p_partkey", found["root"].alias("root"), F.size(found["roots"]).alias("roots"))


@query("ref_parse", """SELECT o_orderkey, 'GEN_' || (o_orderkey % 50 + 1) || '_' || (o_custkey % 30 + 1) AS hebrew, 'MAT_' || CASE WHEN o_orderkey % 2 = 0 THEN '3_4' ELSE (o_orderkey % 28 + 1) || '_' || (o_custkey % 30 + 1) END AS greek,
  'JHN' AS book, (o_orderkey % 21 + 1)::INTEGER AS chapter, CASE WHEN o_custkey % 30 = 0 THEN 'zero' END AS error FROM orders""")
def ref_parse(t: Read) -> DataFrame:
    part = lambda c, m, plus=1: (F.col(c) % m + plus).cast("string")
    hebrew = refs.hebrew_ref(F.concat(F.lit("Gen."), part("o_orderkey", 50), F.lit("."), part("o_custkey", 30), F.lit("#01=L")))
    greek = refs.greek_ref(F.concat(F.lit("Mat."), part("o_orderkey", 28), F.lit("."), part("o_custkey", 30), F.when(F.col("o_orderkey") % 2 == 0, "(1.2)[3.4]").otherwise(""), F.lit("#1=NKO")))
    cross = refs.xref(F.concat(F.lit("John."), part("o_orderkey", 21), F.lit("."), part("o_custkey", 30, 0)))
    # read once a row, in a projection of their own: in one with what uses them, each use would read the cell again
    read = t("orders").select("o_orderkey", hebrew.alias("hebrew"), greek.alias("greek"), cross.alias("cross"))
    return read.select("o_orderkey", refs.canonical_ref(F.col("hebrew"), greek=False).alias("hebrew"), refs.canonical_ref(F.col("greek"), greek=True).alias("greek"), "cross.book", "cross.chapter", "cross.error")


@query("edition_flags", """SELECT count(*) FILTER (l_returnflag = 'N') AS critical, count(*) FILTER (l_linestatus = 'O') AS received, count(*) FILTER (l_returnflag = 'N' AND l_linestatus <> 'O') AS critical_only, count(*) FILTER (l_returnflag <> 'N' AND l_linestatus = 'O') AS received_only FROM lineitem""")
def edition_flags(t: Read) -> DataFrame:
    """Flags stand for edition letters."""
    word = F.concat(F.when(F.col("l_returnflag") == "N", "N").otherwise(""), F.when(F.col("l_linestatus") == "O", "(k)").otherwise(""), F.lit("O"))
    from ..sources.tabular import edition_counts

    return edition_counts(t("lineitem").select(word.alias("edition")))


@query("word_types", """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag = 'N' AS na, l_linestatus = 'O' AS tr_bracketed, count(*) AS n FROM lineitem GROUP BY ALL""")
def word_types(t: Read) -> DataFrame:
    raw = F.concat(F.when(F.col("l_returnflag") == "N", "N").otherwise(""), F.when(F.col("l_linestatus") == "O", "(k)").otherwise("K"))
    made = tags.word_type(raw)
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", made["na"].isNotNull().alias("na"), made["tr"]["bracketed"].alias("tr_bracketed"))
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@query("ext_id_nullout", "SELECT p_partkey, CASE WHEN p_partkey % 9999 + 1 <= 5624 OR p_partkey % 9999 + 1 >= 9000 THEN 'G' || lpad((p_partkey % 9999 + 1)::VARCHAR, 4, '0') END AS kept FROM part")
def ext_id_nullout(t: Read) -> DataFrame:
    return t("part").select("p_partkey", tags.without_entry_nulled(ids.lexicon_id(F.lit("G"), (F.col("p_partkey") % 9999 + 1).cast("string"))).alias("kept"))


# --- versification on stand-ins --------------------------------------------------------------------


def _numbered(t: Read) -> DataFrame:
    """The inventory's rows as verses from 1."""
    return _inventory(t).withColumn("verse", F.col("verse") + 1)


def _edition(t: Read) -> DataFrame:
    """Parts as an edition's verses: the name and type are the text, every 11th verse is empty, the last of a chapter is its greatest."""
    rows = _numbered(t).join(t("part").select("p_partkey", "p_type"), "p_partkey")
    verses = rows.select(F.lit("verse").alias("kind"), "book", "chapter", "verse", F.col("verse").alias("verse_end"), F.when(F.col("p_partkey") % 11 == 0, "").otherwise(F.col("p_type")).alias("text"))
    chapters = verses.groupBy("book", "chapter").agg(F.max("verse").alias("verse_end")).select(F.lit("chapter").alias("kind"), "book", "chapter", F.lit(None).cast("int").alias("verse"), "verse_end", F.when(F.col("chapter") % 2 == 0, "A title").alias("text"))
    return verses.unionByName(chapters)


def _rules(t: Read, target: Column, kind: Column, tests: Column) -> DataFrame:
    """A rule per part: its verse goes to `target` verses further in the same chapter."""
    from ..functions import grammar

    rows = _numbered(t).withColumn("code", ids.rule_code(F.col("book")))
    ref = lambda v: F.concat(F.col("code"), F.lit("."), F.col("chapter").cast("string"), F.lit(":"), v.cast("string"))
    made = rows.select(F.col("p_partkey").cast("int").alias("line_no"), kind.alias("source_type"), ref(F.col("verse")).alias("s"), ref(target).alias("t"), tests.alias("p"), "code")
    made = made.repartition(2 * t("part").sparkSession.sparkContext.defaultParallelism, "line_no")  # a file of one row group is one task, which would parse all
    parsed = made.withColumn("s", grammar.refs_column("s")["items"]).withColumn("t", grammar.refs_column("t")["items"]).withColumn("p", grammar.tests_column("p", "code")["tests"])
    return staged(parsed.select("line_no", "source_type", F.col("s").alias("source"), F.col("t").alias("standard"), F.col("p").alias("tests")), "rules")  # parsed once, as read_rules does


_EDITION = f"""{_INVENTORY}, e AS (SELECT *, book || '_' || chapter || '_' || verse AS id FROM (SELECT i.k, split_part(id, '_', 1) AS book, split_part(id, '_', 2)::INTEGER AS chapter, split_part(id, '_', 3)::INTEGER + 1 AS verse, CASE WHEN i.k % 11 = 0 THEN '' ELSE p_type END AS text
  FROM inventory i JOIN part ON p_partkey = i.k)), l AS (SELECT book, chapter, max(verse) AS last FROM e GROUP BY ALL),
  f AS (SELECT e.*, verse = last AS is_last, CASE WHEN text = '' THEN 0 ELSE len(string_split(text, ' ')) END AS words FROM e JOIN l USING (book, chapter))"""


@query("rule_active", f"""WITH {_EDITION} SELECT f.k::INTEGER AS line_no FROM f LEFT JOIN f n ON n.book = f.book AND n.chapter = f.chapter AND n.verse = 1
  WHERE CASE f.k % 5 WHEN 0 THEN f.text <> '' AND NOT f.is_last AND false WHEN 1 THEN f.text <> '' WHEN 2 THEN f.is_last WHEN 3 THEN f.chapter % 2 = 0 AND f.text <> '' ELSE f.words * 2 > coalesce(n.words, 0) + 1 - 1 END""")
def rule_active(t: Read) -> DataFrame:
    from ..operators.versification import active_rules, features

    here = F.concat(F.col("code"), F.lit("."), F.col("chapter").cast("string"), F.lit(":"))
    own = F.concat(here, F.col("verse").cast("string"))
    m = F.col("p_partkey") % 5
    tests = (
        F.when(m == 0, F.concat(own, F.lit("=Exist & "), own, F.lit("=NotExist"))).when(m == 1, F.concat(own, F.lit("=Exist"))).when(m == 2, F.concat(own, F.lit("=Last")))
        .when(m == 3, F.concat(here, F.lit("TextBeforeV1=Exist & "), own, F.lit("=Exist"))).otherwise(F.concat(own, F.lit("*2 > "), here, F.lit("1")))
    )
    rules = _rules(t, F.col("verse"), F.lit("Hebrew"), tests)
    return active_rules(rules, features(_edition(t))).select("line_no")


def _mapped(t: Read, kind: Column, target: Column) -> DataFrame:
    from ..operators.versification import features, last_verses, map_verses

    edition = _edition(t)
    rules = _rules(t, target, kind, F.when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise(F.concat(F.col("code"), F.lit("."), F.col("chapter").cast("string"), F.lit(":"), F.col("verse").cast("string"), F.lit("=Exist"))))
    verses = edition.filter("kind = 'verse'").select("book", "chapter", "verse")
    mapped = map_verses(verses, rules, features(edition), last_verses(edition), "Hebrew")
    shown = F.array_join(F.transform("targets", lambda x: F.concat_ws("_", x["book"], x["chapter"].cast("string"), x["verse"].cast("string"))), ";")
    return mapped.select(ids.make_id(F.col("book"), F.col("chapter"), F.col("verse")).alias("id"), shown.alias("targets"))


@query("map_identity_default", f"""WITH {_EDITION} SELECT id, CASE WHEN k % 3 = 0 OR text <> '' THEN book || '_' || chapter || '_' || (verse + 1) ELSE id END AS targets FROM f""")
def map_identity_default(t: Read) -> DataFrame:
    return _mapped(t, F.lit("Hebrew"), F.col("verse") + 1)


@query("map_unanimity", f"""WITH {_EDITION} SELECT id, CASE WHEN k % 3 = 0 OR text <> '' THEN book || '_' || chapter || '_' || (verse + k % 2) ELSE id END AS targets FROM f""")
def map_unanimity(t: Read) -> DataFrame:
    """Traditions alternate; each verse has one, so that it decides even where it isn't the wanted one."""
    return _mapped(t, F.when(F.col("p_partkey") % 2 == 0, "Eng+Hebrew").otherwise("Greek"), F.col("verse") + F.col("p_partkey") % 2)


# --- unions, curation, embedding -------------------------------------------------------------------


@query("title_rows_union", "SELECT o_orderkey, l_linenumber AS position, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL UNION ALL SELECT o_orderkey, 0, 1 FROM orders")
def title_rows_union(t: Read) -> DataFrame:
    n = tasks_of(t("lineitem"))
    keys = t("orders").select("o_orderkey").repartition(n, "o_orderkey")
    bodies = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("position")).repartition(n, "o_orderkey").join(keys, "o_orderkey", "left_semi").groupBy("o_orderkey", "position").agg(F.count(F.lit(1)).alias("n"))
    return bodies.unionByName(t("orders").select("o_orderkey", F.lit(0).alias("position"), F.lit(1).cast("long").alias("n")))


@query("source_union", "SELECT 'documents' AS origin, doc_id AS id, length(text) AS size FROM documents UNION ALL SELECT 'benchmark', item_id, length(text) FROM benchmark")
def source_union(t: Read) -> DataFrame:
    one = lambda name, key: t(name).select(F.lit(name).alias("origin"), F.col(key).alias("id"), long(F.length("text")).alias("size"))
    return one("documents", "doc_id").unionByName(one("benchmark", "item_id"))


@query("curation_latest", "SELECT user_id, event_type, round(arg_max(value, event_id), 6) AS value FROM events GROUP BY ALL")
def curation_latest(t: Read) -> DataFrame:
    return curation.latest(t("events"), ["user_id", "event_type"], "value", "event_id").withColumn("value", F.round("value", 6))


@query("report_queue", """WITH r AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS open, count(*) AS degree FROM events GROUP BY user_id)
  SELECT user_id, open, degree, row_number() OVER (ORDER BY open DESC, degree DESC, user_id) AS place FROM r""")
def report_queue(t: Read) -> DataFrame:
    users = t("events").select(F.col("user_id").alias("id")).distinct()
    reports = t("events").select(F.col("user_id").alias("canonicalId"), F.when(F.col("event_type") == "error", "open").otherwise("resolved").alias("status"))
    ranked = curation.queue(users, t("events").select(F.col("user_id").alias("sourceId")), reports)
    placed = ordering.global_position(ranked.withColumn("down", -F.col("open")).withColumn("fewer", -F.col("degree")), "down", "fewer", "id", out="place")
    return placed.select(F.col("id").alias("user_id"), "open", "degree", long(F.col("place")).alias("place"))


_CODES = "[" + ", ".join(f"'{b}'" for b in RULE_BOOKS) + "]"


def _item_sql(verse: str) -> str:
    return f"""'[{{"kind":"single","start":{{"book":"' || code || '","chapter":' || c || ',"verse":' || {verse} || ',"is_title":false}}}}]'"""


@query("rule_parse", f"""WITH r AS (SELECT p_partkey AS k, {_CODES}[(p_partkey // 500) % 66 + 1] AS code, (p_partkey // 10) % 50 + 1 AS c, p_partkey % 10 + p_partkey // 33000 * 10 + 1 AS v FROM part)
  SELECT k::INTEGER AS line_no, 'Hebrew' AS source_type, {_item_sql('v')} AS source, {_item_sql('(v + 1)')} AS standard FROM r""")
def rule_parse(t: Read) -> DataFrame:
    """Rules synthesised from parts, read by the reference grammar."""
    rules = _rules(t, F.col("verse") + 1, F.lit("Hebrew"), F.lit(""))
    return rules.select("line_no", "source_type", F.to_json("source").alias("source"), F.to_json("standard").alias("standard"))


@query("usfx_scan", f"""WITH v AS (SELECT *, {_BOOKS}[n_regionkey + 1] AS book, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS seq FROM nation)
  SELECT 'verse' AS kind, book, 1 AS chapter, n_nationkey + 1 AS verse, n_nationkey + 1 AS verse_end, n_name || ' kept' AS text, seq::INTEGER AS seq FROM v
  UNION ALL SELECT 'chapter', book, 1, NULL, max(n_nationkey) + 1, 'Title', count(*)::INTEGER FROM v GROUP BY book""")
def usfx_scan(t: Read) -> DataFrame:
    """A milestone-marked file per region, read by SAX events."""
    from ..sources import xml

    verse = F.concat(F.lit('<v id="'), (F.col("n_nationkey") + 1).cast("string"), F.lit('"/>'), F.col("n_name"), F.lit(" <f>note</f><add>kept</add><ve/>"))
    bodies = t("nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list(F.struct("n_nationkey", verse.alias("x"))))["x"], "").alias("body"))
    book = F.element_at(F.array(*[F.lit(b) for b in BOOKS]), F.col("n_regionkey") + 1)
    files = bodies.select(F.concat(F.lit('<usfx><book id="'), book, F.lit('"><c id="1"/><d>Title</d>'), "body", F.lit("</book></usfx>")).alias("value"))
    return xml.rows_of(files, xml.parse_usfx, xml.USFX_ROWS)


@query("tagged_words_scan", """WITH w AS (SELECT 'GEN_' || (l_orderkey % 50 + 1) || '_' || l_linenumber AS id, l_partkey, l_suppkey FROM lineitem)
  SELECT id AS canonicalId, row_number() OVER (PARTITION BY id ORDER BY l_partkey * 1000000 + l_suppkey)::INTEGER AS position, 'word' AS lexeme, 'H' || lpad((l_partkey % 8999 + 1)::VARCHAR, 4, '0') AS strongId,
    'H' || lpad((l_partkey % 8999 + 1)::VARCHAR, 4, '0') AS strongRaw, 'N' AS morphology, 'L' AS edition FROM w""")
def tagged_words_scan(t: Read) -> DataFrame:
    """A tagged-word file made of orders' lines, read with its positions."""
    from ..sources.tabular import read_hebrew_words

    cell = F.concat(F.lit("Gen."), (F.col("l_orderkey") % 50 + 1).cast("string"), F.lit("."), (F.col("l_linenumber")).cast("string"), F.lit("#01=L"))
    rows = t("lineitem").select(F.col("l_partkey"), F.col("l_suppkey"), F.concat_ws("\t", cell, F.lit("word"), F.lit(""), F.lit(""), F.concat(F.lit("H"), F.lpad((F.col("l_partkey") % 8999 + 1).cast("string"), 4, "0")), F.lit("N"), *[F.lit("")] * 11).alias("line"))
    numbered = rows.select((F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).alias("line_no"), "line")
    return read_hebrew_words(numbered)[0]


@query("mixed_content_text", "SELECT page_id, 'p' || page_id || ' and more end' AS content FROM pages")
def mixed_content_text(t: Read) -> DataFrame:
    """Document-order text without suppressed subtrees, by XPath alone."""
    made = F.concat(F.lit("<e>p"), F.col("page_id").cast("string"), F.lit("<x>gone</x> and <b>more</b> end</e>"))
    parts = F.xpath(made, F.lit("//text()[not(parent::x)]"))
    return t("pages").select("page_id", text.collapse(F.array_join(parts, "")).alias("content"))


@query("embed_batch", r"""WITH w AS (SELECT doc_id, unnest(CASE WHEN len(l) > 0 THEN l ELSE [''] END) AS w FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS l FROM documents)),
  h AS (SELECT doc_id, ('0x' || md5(w)[1:15])::BIGINT AS h FROM w), v AS (SELECT doc_id, h % 64 AS d, sum(CASE WHEN h >> 59 = 1 THEN 1.0::DOUBLE ELSE -1 END) AS x FROM h GROUP BY ALL),
  n AS (SELECT doc_id, sqrt(sum(x * x)) AS norm, sum((d + 1) * x) AS s FROM v GROUP BY doc_id)
  SELECT doc_id, 64 AS dims, 1.0::DOUBLE AS norm, round(CASE WHEN norm > 0 THEN s / norm ELSE 1 END, 6) AS checksum, 'hash@1' AS model FROM n""")
def embed_batch(t: Read) -> DataFrame:
    """Texts in batches through the deterministic embedder of signed hashes; vectors as their size, norm and a rounded checksum over the dimensions."""
    embedder = HashEmbedder(64)
    rows = embed_texts(t("documents").select("doc_id", "text"), embedder, "hash", "1", 64, keys=("doc_id",))
    checksum = F.aggregate(F.transform("embedding", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return rows.select("doc_id", F.size("embedding").alias("dims"), F.round(retrieval.norm(F.col("embedding")), 6).alias("norm"), F.round(checksum, 6).alias("checksum"), F.col("embeddingModel").alias("model"))


from . import catalog_sources  # noqa: E402, F401  (registers its queries, and those of catalog_guards)
