"""Duplicates and name matching (L), similarity and composition (N)."""

from pyspark.sql import functions as F

from ..functions.similarity import sequence_ratio, token_set_ratio
from ..operators import aggregate, clean, filters, linkage
from .registry import Tables, query

_NORM = r"regexp_replace(strip_accents(trim(regexp_replace(lower({}), '\s+', ' ', 'g'))), '[^\x00-\x7F]', '', 'g')"
_KEYED = f"""WITH k AS (SELECT *, sha256({_NORM.format('text')}) AS k FROM documents),
    g AS (SELECT k, COUNT(*) AS size, ROW_NUMBER() OVER (ORDER BY k) AS gid FROM k GROUP BY 1 HAVING COUNT(*) >= 2),
    d AS (SELECT k.*, COALESCE(gid, 0) AS gid, COALESCE(size, 1) AS size FROM k LEFT JOIN g USING (k)) """


@query(
    "l01_exact_duplicate_groups",
    _KEYED + "SELECT doc_id, gid AS duplicate_group_id, size AS duplicate_group_size FROM d",
)
def l01(t: Tables):
    return linkage.exact_duplicate_labels(t.documents, ["text"], "doc_id")


@query(
    "l01_duplicate_people",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS n, MIN(gid) AS first_group, MAX(gid) AS last_group FROM
       (SELECT *, DENSE_RANK() OVER (ORDER BY k) AS gid FROM (SELECT *, sha256(sha256(CAST(l_orderkey AS VARCHAR)) || sha256(CAST(l_linenumber AS VARCHAR))) AS k,
          COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS c FROM lineitem) WHERE c >= 2) GROUP BY 1, 2""",
)
def l01_people(t: Tables):
    out = linkage.exact_duplicate_groups(t.lineitem, ["l_orderkey", "l_linenumber"])
    return out.groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("duplicate_group_id").alias("first_group"),
        F.max("duplicate_group_id").alias("last_group"),
    )


#: Characters in matching blocks of the rows (id, a, b) of ``pairs``: the longest common block, then the same on both sides of it.
_BLOCKS = """blocks AS (
    SELECT id, a, b, 0 AS size FROM pairs
    UNION ALL
    SELECT id, unnest([substr(a, 1, m.i - 1), substr(a, m.i + m.k)]), unnest([substr(b, 1, j - 1), substr(b, j + m.k)]), unnest([m.k, 0])
    FROM (SELECT *, instr(b, substr(a, m.i, m.k)) AS j FROM
      (SELECT *, list_filter(flatten(list_transform(range(least(length(a), length(b)), 0, -1), lambda k: list_transform(range(1, length(a) - k + 2), lambda i: {'k': k, 'i': i}))),
                             lambda x: contains(b, substr(a, x.i, x.k)))[1] AS m FROM blocks WHERE a <> '' AND b <> '') WHERE m IS NOT NULL)),
    matched AS (SELECT id, sum(size) AS m FROM blocks GROUP BY id)"""

#: The token-set score of the rows (s, o) of ``pairs``, whose sides are compared a character at a time, with a bit for each of the other.
_TOKEN_SCORE = """tokens AS (
    SELECT *, list_sort(list_distinct(list_filter(string_split(s, ' '), lambda w: w <> ''))) AS x, list_sort(list_distinct(list_filter(string_split(o, ' '), lambda w: w <> ''))) AS y FROM pairs),
    sides AS (SELECT *, list_filter(x, lambda w: list_contains(y, w)) AS shared FROM tokens),
    texts AS (SELECT s, o, x, y, shared, length(array_to_string(shared, ' ')) AS n,
        array_to_string(list_concat(shared, list_filter(x, lambda w: NOT list_contains(shared, w))), ' ') AS a,
        array_to_string(list_concat(shared, list_filter(y, lambda w: NOT list_contains(shared, w))), ' ') AS b FROM sides),
    walk AS (
    SELECT a, b, 0 AS i, (1::HUGEINT << length(a)) - 1 AS row FROM (SELECT DISTINCT a, b FROM texts)
    UNION ALL
    SELECT a, b, i + 1, ((row + hit) | (row - hit)) & ((1::HUGEINT << length(a)) - 1) FROM
      (SELECT *, row & list_sum(list_transform(range(1, length(a) + 1), lambda k: CASE WHEN substr(a, k, 1) = substr(b, i + 1, 1) THEN 1::HUGEINT << (k - 1) ELSE 0::HUGEINT END))::HUGEINT AS hit
       FROM walk WHERE i < length(b))),
    ends AS (SELECT a, b, length(a) - bit_count(row) AS c FROM walk WHERE i = length(b)),
    scores AS (SELECT s, o, CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 WHEN n > 0 AND (len(shared) = len(x) OR len(shared) = len(y)) THEN 100.0
        ELSE greatest(200.0 * c / (length(a) + length(b)), CASE WHEN n > 0 THEN greatest(200.0 * n / (n + length(a)), 200.0 * n / (n + length(b))) ELSE 0 END) END AS score
        FROM texts JOIN ends USING (a, b))"""


def _fuzzy_sql(rows: str, row_id: str, cols: list[str], threshold: int, mode: str) -> str:
    """All pairs of values whose lengths and edit distances allow it, scored, and their links followed to the end."""
    texts = ", ".join(f"coalesce({_NORM.format(c)}, 'nan') AS t{i}" for i, c in enumerate(cols))
    names = ", ".join(f"t{i}" for i in range(len(cols)))
    near = " AND ".join(
        f"2 * least(length(x.t{i}), length(y.t{i})) >= {threshold / 100} * (length(x.t{i}) + length(y.t{i})) - 1e-9 AND levenshtein(x.t{i}, y.t{i}) <= {1 - threshold / 100} * (length(x.t{i}) + length(y.t{i})) + 1e-9"
        for i in range(len(cols))
    )
    both = " UNION ALL ".join(f"SELECT u, v, d, {i} AS c, CASE WHEN d = 0 THEN a{i} ELSE b{i} END AS a, CASE WHEN d = 0 THEN b{i} ELSE a{i} END AS b FROM directed" for i in range(len(cols)))
    sides = ", ".join(f"x.t{i} AS a{i}, y.t{i} AS b{i}" for i in range(len(cols)))
    return f"""WITH RECURSIVE d AS ({rows}), normal AS (SELECT *, {texts} FROM d),
    values_ AS (SELECT {names}, min({row_id}) AS vid, max({row_id}) AS last, count(*) AS n FROM normal GROUP BY {names}),
    close AS (SELECT x.vid AS u, y.vid AS v, x.last AS last, {sides} FROM values_ x JOIN values_ y ON x.vid < y.vid AND {near}),
    directed AS (SELECT *, 0 AS d FROM close UNION ALL SELECT *, 1 AS d FROM close WHERE v < last),
    sided AS ({both}),
    pairs AS (SELECT ROW_NUMBER() OVER () AS id, a, b FROM (SELECT DISTINCT a, b FROM sided)), {_BLOCKS},
    ratios AS (SELECT a, b, CASE WHEN length(a) + length(b) = 0 THEN 100.0 ELSE 200.0 * m / (length(a) + length(b)) END AS ratio FROM pairs JOIN matched USING (id)),
    edges AS (SELECT DISTINCT u, v FROM (SELECT u, v, d FROM sided JOIN ratios USING (a, b) GROUP BY u, v, d HAVING min(ratio) >= {threshold})),
    links AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
    reach AS (SELECT vid AS node, vid AS other FROM values_ UNION SELECT r.node, l.v FROM reach r JOIN links l ON l.u = r.other),
    roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node),
    groups AS (SELECT root, sum(n) AS size FROM roots JOIN values_ ON vid = node GROUP BY root HAVING sum(n) >= 2),
    numbered AS (SELECT root, size, ROW_NUMBER() OVER (ORDER BY sha256(CAST(root AS VARCHAR))) AS gid FROM groups)
    SELECT d.*, COALESCE(gid, 0)::BIGINT AS duplicate_group_id, COALESCE(size, 1)::BIGINT AS duplicate_group_size
    FROM normal JOIN values_ USING ({names}) JOIN roots ON node = vid LEFT JOIN numbered USING (root) JOIN d USING ({row_id}) {"" if mode == "all" else "WHERE gid > 0"}"""


_SLIPS = """SELECT p_partkey, CASE WHEN p_partkey % 4 = 1 THEN regexp_replace(p_name, 'g', 'gg', 'g')
    WHEN p_partkey % 4 = 2 THEN array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') ELSE p_name END AS name, p_type FROM part"""


def similar_names(t: Tables):
    """Party names with a typing slip in some of them; every name repeats."""
    slip = F.when(F.col("p_partkey") % 4 == 1, F.regexp_replace("p_name", "g", "gg")).when(
        F.col("p_partkey") % 4 == 2, F.initcap("p_name")
    )
    return t.part.select("p_partkey", F.coalesce(slip, F.col("p_name")).alias("name"), "p_type")


@query("l02_fuzzy_duplicate_groups", _fuzzy_sql(_SLIPS, "p_partkey", ["name", "p_type"], 88, "all"))
def l02(t: Tables):
    return linkage.fuzzy_duplicate_groups(similar_names(t), ["name", "p_type"], "p_partkey", threshold=88, mode="all")


@query(
    "l02_fuzzy_site_names",
    _fuzzy_sql("SELECT s_suppkey, n_name || ' ' || substr(md5(CAST(s_suppkey AS VARCHAR)), 1, 4) AS site FROM supplier JOIN nation ON s_nationkey = n_nationkey", "s_suppkey", ["site"], 85, "duplicates"),
)
def l02_sites(t: Tables):
    # sites of a country differ in a code of four characters, of which a link needs three
    code = F.substring(F.md5(F.col("s_suppkey").cast("string").cast("binary")), 1, 4)
    sites = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.concat_ws(" ", "n_name", code).alias("site"))
    return linkage.fuzzy_duplicate_groups(sites, ["site"], "s_suppkey", threshold=85)


@query(
    "l03_keep_most_null",
    _KEYED
    + """, n AS (SELECT doc_id, gid, (CASE WHEN lang <> 'en' THEN 1 ELSE 0 END) + (CASE WHEN n_chars % 2 = 0 THEN 1 ELSE 0 END) + (CASE WHEN source < 'src2' THEN 1 ELSE 0 END) AS nulls FROM d)
        SELECT doc_id FROM n WHERE gid = 0 UNION ALL SELECT doc_id FROM
        (SELECT *, ROW_NUMBER() OVER (PARTITION BY gid ORDER BY nulls DESC, doc_id) AS rn FROM n WHERE gid > 0) WHERE rn = 1""",
)
def l03(t: Tables):
    labels = linkage.exact_duplicate_labels(t.documents, ["text"], "doc_id")
    groups = t.documents.drop("text").join(labels, "doc_id").select(
        "doc_id",
        F.when(F.col("lang") == "en", F.col("lang")).alias("lang"),
        F.when(F.col("n_chars") % 2 == 1, F.col("n_chars")).alias("n_chars"),
        F.when(F.col("source") >= "src2", F.col("source")).alias("source"),
        "duplicate_group_id",
        "duplicate_group_size",
    )
    return linkage.keep_most_null(groups, "doc_id", "all", case_id="doc_id").select("doc_id")


_NAME_SET = f"array_to_string(list_sort(list_distinct(list_filter(string_split({_NORM}, ' '), lambda w: w <> ''))), ' ')"


def _best_name_sql(left: str, right: str, threshold: int) -> str:
    """Every name against every other."""
    return f"""WITH RECURSIVE l AS (SELECT *, {_NAME_SET.format('name')} AS s FROM ({left})),
    r AS (SELECT {_NAME_SET.format('name')} AS o, min(name) AS best_match FROM ({right}) GROUP BY 1),
    pairs AS (SELECT s, o FROM (SELECT DISTINCT s FROM l), r), {_TOKEN_SCORE},
    best AS (SELECT * FROM scores JOIN r USING (o) QUALIFY ROW_NUMBER() OVER (PARTITION BY s ORDER BY score DESC, s = o DESC, best_match) = 1)
    SELECT l.* EXCLUDE (s), CASE WHEN score >= {threshold} THEN best_match END AS best_match, COALESCE(floor(score), 0)::INT AS score,
           CASE WHEN score >= {threshold} THEN 'yes' ELSE 'no' END AS correspondance FROM l LEFT JOIN best USING (s)"""


@query(
    "l04_best_name_match",
    _best_name_sql("SELECT p_partkey, regexp_replace(upper(p_name), '^(\\S+) (\\S+)$', '\\2  \\1') AS name FROM part", f"SELECT name FROM ({_SLIPS})", 85),
)
def l04(t: Tables):
    reference = t.part.select("p_partkey", F.regexp_replace(F.upper("p_name"), "^(\\S+) (\\S+)$", "$2  $1").alias("name"))
    slips = similar_names(t).select("name")
    return linkage.best_name_match(reference, slips, threshold=85)


@query(
    "l04_names_without_match",
    _best_name_sql("SELECT s_suppkey, 'Supplier ' || substr(md5(CAST(s_suppkey AS VARCHAR)), 1, 7) AS name FROM supplier", "SELECT c_mktsegment || ' ' || (c_custkey % 97) AS name FROM customer", 85),
)
def l04_low(t: Tables):
    # no name comes near a match, so each needs its best score far below the threshold
    code = F.substring(F.md5(F.col("s_suppkey").cast("string").cast("binary")), 1, 7)
    reference = t.supplier.select("s_suppkey", F.concat_ws(" ", F.lit("Supplier"), code).alias("name"))
    others = t.customer.select(F.concat_ws(" ", "c_mktsegment", (F.col("c_custkey") % 97).cast("string")).alias("name"))
    return linkage.best_name_match(reference, others, threshold=85)


@query(
    "l05_remove_known_duplicates",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000)",
)
def l05(t: Tables):
    known = t.orders.where("o_totalprice > 490000").select(F.col("o_custkey").alias("c_custkey"))
    return linkage.remove_known_duplicates(t.customer, known, "c_custkey").select("c_custkey", "c_name")


@query(
    "n01_pipe",
    """SELECT o_custkey AS person, COUNT(*) AS n FROM orders WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-01-01'
       AND o_orderpriority NOT IN ('5-LOW') GROUP BY 1""",
)
def n01(t: Tables):
    return clean.pipe(
        t.orders,
        (filters.between_dates, "o_orderdate", "1998-01-01", "1998-12-31"),
        (filters.exclude_values, "o_orderpriority", ["5-LOW"]),
        (clean.rename_cols, {"o_custkey": "person"}),
        lambda df: df.groupBy("person").agg(F.count(F.lit(1)).alias("n")),
    )


@query(
    "n02_sequence_ratio",
    f"""WITH RECURSIVE pairs AS (SELECT ROW_NUMBER() OVER () AS id, a, b FROM (SELECT DISTINCT lower(p_type) AS a, p_name AS b FROM part)), {_BLOCKS}
    SELECT p_partkey, round(200.0 * m / (length(a) + length(b)), 6) AS score FROM part JOIN pairs ON a = lower(p_type) AND b = p_name JOIN matched USING (id)""",
)
def n02(t: Tables):
    return t.part.select("p_partkey", F.round(sequence_ratio(F.lower("p_type"), F.col("p_name")), 6).alias("score"))


@query(
    "n03_token_set_ratio",
    f"""WITH RECURSIVE swapped AS (SELECT p_partkey, p_name AS s, regexp_replace(regexp_replace(p_name, '^(\\S+) (\\S+)$', '\\2 new \\1'), '([aeiou])(\\S)$', '\\2\\1') AS o FROM part),
    pairs AS (SELECT DISTINCT s, o FROM swapped), {_TOKEN_SCORE}
    SELECT p_partkey, round(score, 6) AS score FROM swapped JOIN scores USING (s, o)""",
)
def n03(t: Tables):
    # the words swapped, and a slip in one of them, so neither side contains the other
    swapped = F.regexp_replace(F.regexp_replace("p_name", "^(\\S+) (\\S+)$", "$2 new $1"), "([aeiou])(\\S)$", "$2$1")
    return t.part.select("p_partkey", F.round(token_set_ratio(F.col("p_name"), swapped), 6).alias("score"))


_KEEP = """SELECT o_custkey, o_orderkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY
    (CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) + (CASE WHEN o_totalprice < 100000 THEN 1 ELSE 0 END) DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1"""


@query("n04_group_keep_one", _KEEP)
def n04(t: Tables):
    rows = t.orders.select(
        "o_custkey",
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_totalprice") >= 100000, F.col("o_totalprice")).alias("price"),
        (F.col("o_custkey") + 1).alias("duplicate_group_id"),
        F.lit(2).cast("long").alias("duplicate_group_size"),
    )
    return linkage.keep_most_null(rows, "o_orderkey").select("o_custkey", "o_orderkey")


@query(
    "n05_count_if",
    "SELECT c_nationkey, COUNT(*) FILTER (c_mktsegment = 'BUILDING') AS eligible, COUNT(*) FILTER (c_acctbal < 0) AS owing FROM customer GROUP BY 1",
)
def n05(t: Tables):
    conds = {"eligible": F.col("c_mktsegment") == "BUILDING", "owing": F.col("c_acctbal") < 0}
    return aggregate.conditional_counts(t.customer, "c_nationkey", conds)
