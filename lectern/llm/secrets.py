"""Secret scans over a trigram inverted index, with DataFrame functions alone.

1. Each rule's regular expression gives a Boolean query over trigrams: an OR of ANDs that every match
   satisfies (read off its parse tree; ASCII letters folded to lower case).
2. The index has one posting (trigram, row key) per trigram of any query and text that holds it.
3. Postings are intersected by row key and the queries answered: these are a rule's candidates.
4. Candidates are verified with the expression itself. A rule without mandatory trigrams scans every text
   as the index is made; the texts it matches are its candidates.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

_parser = re._parser


@dataclass(frozen=True)
class Rule:
    """`pattern` finds leftmost non-overlapping matches; those whose `kept` group is under `least` characters are dropped.

    Patterns use what Java, RE2 and Python read alike: no look-around, anchors or back-references.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The first three are the contract's. `{n,}` on a class that cannot overlap its own continuation equals `+` with the shorter runs dropped.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

#: A set of strings that grows beyond this is turned into its trigrams and begun anew.
MOST_STRINGS = 48


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """An OR of ANDs of lower-case trigrams that each match satisfies; None: no trigram is mandatory."""
    strings, clauses = _walk(_parser.parse(pattern))
    clauses = _both(clauses, _clauses(strings))
    return None if clauses is None else sorted((c for c in set(clauses) if not any(other < c for other in clauses)), key=sorted)


def _clauses(strings: set[str]) -> list[frozenset[str]] | None:
    """The query of 'one of these strings'."""
    found = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
    return None if not all(found) else found


def _both(x, y):
    if x is None or y is None:
        return y if x is None else x
    return [a | b for a in x for b in y]


def _walk(parsed) -> tuple[set[str], list[frozenset[str]] | None]:
    """Of a sequence: the strings that its end so far can be, and the query of what came before them."""
    strings, query = {""}, None
    for op, arg in parsed:
        piece = _strings(op, arg)
        if piece is not None and len(strings) * len(piece) <= MOST_STRINGS:
            strings = {a + b for a, b in product(strings, piece)}
            continue
        query = _both(query, _clauses(strings))
        strings = piece if piece is not None else {""}
        if piece is None and str(op) == "SUBPATTERN":
            ends, inner = _walk(arg[3])
            query = _both(_both(query, inner), _clauses(ends))
        elif piece is None and str(op) == "MAX_REPEAT" and arg[0] >= 1:
            ends, inner = _walk(arg[2])
            query = _both(_both(query, inner), _clauses(ends))
    return strings, query


def _strings(op, arg) -> set[str] | None:
    """All strings that a node can match, lower case, if they are few."""
    op = str(op)
    if op == "LITERAL":
        return {chr(arg).lower()} if arg < 128 else {chr(arg)}
    if op == "IN" and all(str(k) == "LITERAL" for k, _ in arg) and len(arg) <= 6:
        return {chr(v).lower() for _, v in arg}
    if op == "SUBPATTERN":
        return _sequence(arg[3])
    if op == "BRANCH":
        each = [_sequence(x) for x in arg[1]]
        return None if None in each else set().union(*each)
    if op == "MAX_REPEAT" and arg[1] <= 6 and arg[1] != _parser.MAXREPEAT:
        one = _sequence(arg[2])
        return None if one is None else {"".join(x) for n in range(arg[0], arg[1] + 1) for x in product(one, repeat=n)}
    return None


def _sequence(parsed) -> set[str] | None:
    strings = {""}
    for op, arg in parsed:
        piece = _strings(op, arg)
        if piece is None or len(strings) * len(piece) > MOST_STRINGS:
            return None
        strings = {a + b for a, b in product(strings, piece)}
    return strings


def trigram_index(df: DataFrame, key: str, text: str, grams: list[str], scans: dict[str, str]) -> DataFrame:
    """Postings (gram: int, key) of the given lower-case trigrams; a rule without any scans the text here, and its kind stands for a gram."""
    low = df.select(F.col(key), F.col(text), F.lower(F.col(text)).alias("__low"))
    found = [F.when(F.rlike(F.col(text), F.lit(scans[g])) if g in scans else F.contains(F.col("__low"), F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]
    return low.select(key, F.explode(F.array_compact(F.array(*found))).alias("gram"))


def candidates(postings: DataFrame, key: str, queries: dict[str, list[frozenset[str]]], grams: list[str]) -> DataFrame:
    """Row keys with the list of rules whose trigram query they satisfy."""
    words = -(-len(grams) // 62)
    bits = [F.bit_or(F.when(F.floor(F.col("gram") / 62) == w, F.expr("shiftleft(1L, cast(gram % 62 AS INT))")).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in range(words)]
    sets = postings.groupBy(key).agg(*bits)

    def holds(clause: frozenset[str]) -> Column:
        masks = [sum(1 << grams.index(g) % 62 for g in clause if grams.index(g) // 62 == w) for w in range(words)]
        return reduce(lambda a, b: a & b, [F.col(f"w{w}").bitwiseAND(F.lit(m)) == m for w, m in enumerate(masks) if m])

    rules = [F.when(reduce(lambda a, b: a | b, map(holds, q)), F.lit(kind)) for kind, q in queries.items()]
    return sets.select(key, F.array_compact(F.array(*rules)).alias("rules")).filter(F.size("rules") > 0)


def let(value: Column, use) -> Column:
    """use(value), with the value worked out once, however often it is used and within whatever lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _matches(rule: Rule, order: int, text: Column) -> Column:
    """All matches of a rule in the order of the text: the rule's place, their number, the characters since the match before, their length, and whether they count."""
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    size = lambda m: F.struct(F.length(m).alias("own"), (F.length(F.regexp_extract(m, rule.pattern, rule.group)) >= rule.least).alias("kept"))
    found = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), size)
    both = F.zip_with(found, between, lambda m, gap: F.struct(gap.alias("gap"), m["own"].alias("own"), m["kept"].alias("kept")))
    numbered = F.transform(both, lambda x, i: F.struct(F.lit(order).alias("k"), i.alias("nth"), x["gap"].alias("gap"), x["own"].alias("own"), x["kept"].alias("kept")))
    return F.filter(numbered, lambda x: x["own"].isNotNull())  # the stretch after the last match has none


def find_secrets(df: DataFrame, text: str = "text", key: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds `secrets`: all spans array<struct<start, k, end>> (code points, end exclusive, k the rule's place), sorted; and `secrets_before`: where the spans before each of them end, 0 for the first.

    A null or empty text has none. Rows with the same key and text (null keys too) share their postings
    and spans. A very long text is searched whole; its matches are rows until their places are summed up, so
    that the work is linear in their number. An empty table gives an empty table. Columns of
    these two names are replaced; names that begin with two underscores are reserved.

    Texts stay where they are: only those of candidates go to the join with their rules, and the spans
    come back by key.
    """
    scans = {r.kind: r.pattern for r in rules if trigram_query(r.pattern) is None}
    queries = {r.kind: [frozenset({r.kind})] if r.kind in scans else trigram_query(r.pattern) for r in rules}
    grams = sorted({g for q in queries.values() for clause in q for g in clause})
    rows = df.drop("secrets", "secrets_before").withColumn("__k", F.xxhash64(F.col(key), F.col(text))).withColumn("__j", F.hash(F.col(key), F.col(text)))
    texts = rows.select("__k", "__j", F.coalesce(F.col(text), F.lit("")).alias("__t")).filter(F.length("__t") > 2)
    postings = cut(trigram_index(texts, "__k", "__t", grams, scans), "postings")
    found = cut(candidates(postings, "__k", queries, grams), "candidates")
    wanted = texts.join(found, "__k")
    none = F.array().cast("array<struct<k:int,nth:int,gap:int,own:int,kept:boolean>>")
    each = F.concat(*[F.when(F.array_contains("rules", rule.kind), _matches(rule, i, F.col("__t"))).otherwise(none) for i, rule in enumerate(rules)])
    matches = wanted.select("__k", "__j", F.explode(each).alias("m")).select("__k", "__j", "m.*").distinct()  # rows that repeat have the same matches
    so_far = Window.partitionBy("__k", "__j", "k").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    placed = matches.withColumn("end", F.sum(F.col("gap") + F.col("own")).over(so_far).cast("int")).filter("kept")
    earlier = Window.partitionBy("__k", "__j").orderBy("start", "k").rowsBetween(Window.unboundedPreceding, -1)
    spans = placed.select("__k", "__j", (F.col("end") - F.col("own")).alias("start"), "k", "end").withColumn("before", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    once = cut(spans.groupBy("__k", "__j").agg(F.array_sort(F.collect_list(F.struct("start", "k", "end", "before"))).alias("__s")), "spans")
    empty = F.array().cast("array<struct<start:int,k:int,end:int,before:int>>")
    out = rows.join(once, ["__k", "__j"], "left").withColumn("__s", F.coalesce("__s", empty))
    out = out.withColumn("secrets", F.transform("__s", lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"))))
    return out.withColumn("secrets_before", F.col("__s.before")).drop("__k", "__j", "__s")


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """Replaces each stretch covered by `secrets` by [kind] (by the first kind where spans overlap), in what `find_secrets` returns."""
    t, names = F.col(text), F.array(*[F.lit(f"[{r.kind}]") for r in RULES])
    both = F.zip_with("secrets", "secrets_before", lambda s, before: F.struct(s["start"].alias("start"), s["k"].alias("k"), before.alias("before")))
    fresh = F.filter(both, lambda s: s["start"] >= s["before"])

    def replaced(wide: Column) -> Column:
        """Of a text at four bytes a character, so that a stretch is found without counting from the start."""
        stretch = lambda at, n: F.decode(F.substring(wide, at * 4 + 1, n * 4), "UTF-32")
        pieces = F.transform(fresh, lambda s: F.concat(stretch(s["before"], s["start"] - s["before"]), F.get(names, s["k"])))
        last = F.array_max(F.transform("secrets", lambda s: s["end"]))
        return F.concat(F.array_join(pieces, ""), stretch(last, F.length(t) - last))

    return df.withColumn(text, F.when(F.size("secrets") > 0, let(F.encode(t, "UTF-32"), replaced)).otherwise(t))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kinds = F.array(*[F.lit(r.kind) for r in RULES])
    out = find_secrets(docs)

    def of(k: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["k"] == k)).cast("long")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("secrets", lambda s: s["k"] < 3)
    return out.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), F.sha2(F.encode(listed(base), "UTF-8"), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))


def _sql_kind(rule: Rule, order: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    for word in ("password", "passwd", "secret", "token", "api", "key"):
        if "(?i:" in rule.pattern:
            pattern = re.sub(rf"\b{word}|(?<=_\?){word}", "".join(f"[{c.upper()}{c}]" for c in word), pattern)
    pattern = pattern.replace("(?i:", "(?:")
    # the stretches between matches: replace each by a character that no text holds, then split at it
    kept = f"length(regexp_extract(m[i], '{pattern}', {rule.group})) >= {rule.least}"
    return f"""SELECT doc_id, {order} AS k, '{rule.kind}' AS kind,
      unnest([struct_pack(s := list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0),
              e := list_sum(list_transform(p[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))))
        for i in range(1, len(m) + 1) if {kept}]) AS span
    FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p FROM t WHERE regexp_matches(t, '{pattern}'))"""


ORACLE = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({' UNION ALL '.join(_sql_kind(r, i) for i, r in enumerate(RULES))}),
g AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || span.s::BIGINT || ':' || span.e::BIGINT, ',' ORDER BY span.s, k) FILTER (k < 3) AS base,
    string_agg(kind || ':' || span.s::BIGINT || ':' || span.e::BIGINT, ',' ORDER BY span.s, k) AS spans
  FROM s GROUP BY doc_id
)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (doc_id)
"""
