"""Queries of tree lookups and assignments, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import known
from ..operators import assignment as A
from ..operators import taxonomy
from ..sources.tables import table
from .book import Book
from .reference import _fold, _has, _known, _slug

book = Book()
query = book.query
QUERIES, SQL = book.queries, book.sql

LEVELS = ["taxonomy_level_1", "taxonomy_level_2", "taxonomy_level_3", "taxonomy_level_4"]


def _tree_sql() -> str:
    parts = []
    for i in range(len(LEVELS)):
        path = " || '/' || ".join(_slug(f"trim({_known(c)})") for c in LEVELS[: i + 1])
        up = " || '/' || ".join(_slug(f"trim({_known(c)})") for c in LEVELS[:i]) if i else "NULL::VARCHAR"
        parts.append(f"SELECT {path} AS node, {up} AS parent, {i + 1} AS level, trim({LEVELS[i]}) AS label FROM cementitious WHERE " + " AND ".join(_has(c) for c in LEVELS[: i + 1]))
    return f"tree AS (SELECT node, parent, level::INT AS level, min(label) AS label FROM ({' UNION ALL '.join(parts)}) GROUP BY 1, 2, 3)"


_TREE = _tree_sql()
_LAST = "list_last(string_split({0}, '/'))"


def _tree(spark, d):
    return A.tree_of(table(spark, d, "cementitious"), LEVELS)


@query(f"WITH {_TREE} SELECT node, label, level, row_number() OVER (ORDER BY level, node)::INT AS place FROM tree")
def ordered_nodes(spark, d):
    """All nodes of the tree in order of level and path."""
    return A.ordered(_tree(spark, d)).select("node", "label", "level", "place")


@query(f"WITH {_TREE} SELECT parent, row_number() OVER (PARTITION BY parent ORDER BY node)::INT AS place, node, label FROM tree WHERE parent IS NOT NULL")
def ordered_children(spark, d):
    """The children of each node in order."""
    return A.children(_tree(spark, d))


@query(f"""WITH {_TREE}, r AS (SELECT node, level, CASE WHEN level = 4 THEN 'leaf' WHEN level = 3 THEN CASE WHEN EXISTS (SELECT 1 FROM tree c WHERE c.parent = t.node) THEN 'parent' ELSE 'end' END ELSE 'branch' END AS role FROM tree t) SELECT *, role IN ('leaf', 'end') AS searched FROM r""")
def node_roles(spark, d):
    """What each node is for a search: leaf, childless end, parent, branch."""
    return A.roles(_tree(spark, d), 4).select("node", "level", "role", "searched")


_KEYS = f"""kk AS (SELECT parent, node, {_fold("label")} AS key FROM tree UNION SELECT parent, node, {_fold("replace(" + _LAST.format("node") + ", '_', ' ')")} FROM tree), ks AS (SELECT parent, key, min(node) AS node FROM kk WHERE key <> '' GROUP BY 1, 2)"""
_ROWS = f"""r AS (SELECT DISTINCT record_id, {_slug(f"trim({_known(LEVELS[0])})")} || '/' || {_slug(f"trim({_known(LEVELS[1])})")} || '/' || {_slug(f"trim({_known(LEVELS[2])})")} AS p, upper(replace(taxonomy_level_4, '-', ' ')) AS x, 'variant of ' || taxonomy_level_4 || ' type' AS y FROM cementitious WHERE {" AND ".join(_has(c) for c in LEVELS)})"""


def _rows(spark, d):
    from ..functions.scalars import slug

    path = F.array_join(F.array(*[slug(F.trim(known(c))) for c in LEVELS[:3]]), "/")
    c = table(spark, d, "cementitious").where(" AND ".join(f"`{c}` IS NOT NULL" for c in LEVELS))
    for x in LEVELS:
        c = c.where(known(x).isNotNull())
    return c.select("record_id", path.alias("p"), F.upper(F.replace("taxonomy_level_4", F.lit("-"), F.lit(" "))).alias("x"), F.concat(F.lit("variant of "), F.col("taxonomy_level_4"), F.lit(" type")).alias("y")).distinct()


@query(f"WITH {_TREE}, {_KEYS}, {_ROWS} SELECT record_id, x, ks.node AS child FROM r LEFT JOIN ks ON ks.parent = r.p AND ks.key = {_fold('x')}")
def find_children(spark, d):
    """Children named by label, slug or alias in any case."""
    return A.find_child(_rows(spark, d), "p", "x", _tree(spark, d)).select("record_id", "x", "child")


_LOOSE = f"""w AS (SELECT DISTINCT p, lower(trim(y)) AS t FROM r WHERE {_has("y")}), we AS (SELECT w.*, ks.node AS e FROM w LEFT JOIN ks ON ks.parent = p AND ks.key = {_fold("t")}), fm AS (SELECT parent, node, lower(label) AS f FROM tree UNION SELECT parent, node, {_LAST.format("node")} FROM tree),
lo AS (SELECT p, t, min(fm.node) AS l FROM we JOIN fm ON fm.parent = p AND (contains(t, f) OR contains(f, t)) WHERE e IS NULL GROUP BY 1, 2), mc AS (SELECT we.p, we.t, coalesce(e, l) AS child FROM we LEFT JOIN lo ON lo.p = we.p AND lo.t = we.t)"""


@query(f"WITH {_TREE}, {_KEYS}, {_ROWS}, {_LOOSE} SELECT record_id, child FROM r JOIN mc ON mc.p = r.p AND mc.t = lower(trim(y))")
def loose_children(spark, d):
    """Children whose name holds a variant's text or is held by it."""
    return A.match_child(_rows(spark, d), "record_id", "p", "y", _tree(spark, d))


_MAP = f"""mp AS (SELECT subcategory AS leaf, min({_slug(LEVELS[1])}) AS s2, arg_min(taxonomy_level_2, {_slug(LEVELS[1])} || '/' || {_slug(LEVELS[2])}) AS level_2, arg_min(taxonomy_level_3, {_slug(LEVELS[1])} || '/' || {_slug(LEVELS[2])}) AS level_3, min({_slug(LEVELS[0])} || '/' || {_slug(LEVELS[1])} || '/' || {_slug(LEVELS[2])}) AS node FROM cementitious WHERE {" AND ".join(_has(c) for c in ["subcategory", *LEVELS[:3]])} GROUP BY 1)"""


def _mapping(spark, d):
    from ..functions.scalars import slug

    c = table(spark, d, "cementitious")
    for x in ["subcategory", *LEVELS[:3]]:
        c = c.where(known(x).isNotNull())
    path = F.concat_ws("/", slug(LEVELS[0]), slug(LEVELS[1]), slug(LEVELS[2]))
    low = F.concat_ws("/", slug(LEVELS[1]), slug(LEVELS[2]))
    g = c.groupBy(F.col("subcategory").alias("leaf")).agg(F.min(path).alias("node"), F.min(F.struct(low.alias("k"), "taxonomy_level_2", "taxonomy_level_3")).alias("m"))
    return g.select("leaf", F.col("m.taxonomy_level_2").alias("level_2"), F.col("m.taxonomy_level_3").alias("level_3"), "node")


@query(f"""WITH {_TREE}, {_KEYS}, {_MAP}, q AS (SELECT DISTINCT record_id, subcategory AS l, taxonomy_level_4 AS v FROM cementitious), j AS (SELECT q.record_id, l, v, mp.level_2, mp.level_3, mp.node AS p, lower(trim(v)) AS t FROM q LEFT JOIN mp ON mp.leaf = l),
w AS (SELECT DISTINCT p, t FROM j WHERE {_has("v")} AND p IS NOT NULL), we AS (SELECT w.*, ks.node AS e FROM w LEFT JOIN ks ON ks.parent = p AND ks.key = {_fold("t")}), fm AS (SELECT parent, node, lower(label) AS f FROM tree UNION SELECT parent, node, {_LAST.format("node")} FROM tree),
lo AS (SELECT p, t, min(fm.node) AS l FROM we JOIN fm ON fm.parent = p AND (contains(t, f) OR contains(f, t)) WHERE e IS NULL GROUP BY 1, 2), mc AS (SELECT we.p, we.t, coalesce(e, l) AS child FROM we LEFT JOIN lo ON lo.p = we.p AND lo.t = we.t),
ch AS (SELECT j.record_id, min(tree.label) AS level_4 FROM j JOIN mc ON mc.p = j.p AND mc.t = j.t JOIN tree ON tree.node = mc.child GROUP BY 1)
SELECT j.record_id, coalesce(level_2, 'N.A.') AS level_2, coalesce(level_3, 'N.A.') AS level_3, coalesce(level_4, 'N.A.') AS level_4 FROM j LEFT JOIN ch USING (record_id)""")
def applied_paths(spark, d):
    """Levels of each record from its leaf's mapping, level 4 by its variant, padded."""
    c = table(spark, d, "cementitious").select("record_id", "subcategory", "taxonomy_level_4").distinct()
    return A.apply_path(c, "record_id", "subcategory", "taxonomy_level_4", _mapping(spark, d), _tree(spark, d))


_LEAVES = f"""mm AS (SELECT leaf, level_3, level_4, row_number() OVER (ORDER BY leaf, level_3, level_4)::INT AS place FROM (SELECT DISTINCT alternative_classification AS leaf, taxonomy_level_3 AS level_3, taxonomy_level_4 AS level_4 FROM cementitious WHERE {_has("alternative_classification")} AND {_has("taxonomy_level_3")}))"""


@query(f"""WITH {_LEAVES}, nn AS (SELECT DISTINCT taxonomy_level_3 || '/' || coalesce(taxonomy_level_4, '') AS node, taxonomy_level_3 AS l3, taxonomy_level_4 AS l4 FROM cementitious WHERE {_has("taxonomy_level_3")}),
x AS (SELECT node, leaf, 0 AS r, place AS o FROM nn JOIN mm ON l4 = level_4 AND l3 = level_3 AND {_has("l4")} UNION ALL SELECT node, leaf, 1, -place FROM nn JOIN mm ON l3 = level_3)
SELECT node, leaf FROM x QUALIFY row_number() OVER (PARTITION BY node ORDER BY r, o, leaf) = 1""")
def reverse_mapping(spark, d):
    """The leaf that maps onto each node: by level 4, else the last by level 3."""
    from pyspark.sql import Window as W

    c = table(spark, d, "cementitious").where(known("taxonomy_level_3").isNotNull())
    m = c.where(known("alternative_classification").isNotNull()).select(F.col("alternative_classification").alias("leaf"), F.col("taxonomy_level_3").alias("level_3"), F.col("taxonomy_level_4").alias("level_4")).distinct()
    m = m.withColumn("place", F.row_number().over(W.orderBy("leaf", "level_3", F.asc_nulls_last("level_4"))))  # a mapping is configuration
    n = c.select(F.concat(F.col("taxonomy_level_3"), F.lit("/"), F.coalesce("taxonomy_level_4", F.lit(""))).alias("node"), F.col("taxonomy_level_3").alias("level_3"), F.col("taxonomy_level_4").alias("level_4")).distinct()
    return A.reverse_path(n, m)


@query(f"""WITH {_TREE}, dm AS (SELECT {_fold("label")} AS k, min(label) AS label FROM tree WHERE level = 1 GROUP BY 1), v AS (SELECT DISTINCT lower(replace(taxonomy_level_1, '-', '_')) AS t FROM cementitious WHERE {_has("taxonomy_level_1")} UNION SELECT 'nowhere')
SELECT t, coalesce(label, t) AS label FROM v LEFT JOIN dm ON dm.k = {_fold("replace(t, '_', ' ')")}""")
def resolved_slugs(spark, d):
    """Slugs and labels resolved to the dimension's label."""
    v = table(spark, d, "cementitious").where(known("taxonomy_level_1").isNotNull()).select(F.lower(F.replace("taxonomy_level_1", F.lit("-"), F.lit("_"))).alias("t")).union(spark.createDataFrame([("nowhere",)], "t string")).distinct()
    dim = _tree(spark, d).where("level = 1")
    return A.resolve(v, "t", dim, "node", "label", "label")


@query(f"""WITH {_TREE}, big AS (SELECT * FROM tree WHERE NOT (level = 2 AND node LIKE 'l1_02/%')), v AS (SELECT DISTINCT record_id, lower(trim({_known(LEVELS[0])})) AS a, lower(trim({_known(LEVELS[1])})) AS b FROM (SELECT record_id, {LEVELS[0]}, CASE WHEN record_id LIKE '%7' THEN {LEVELS[2]} ELSE {LEVELS[1]} END AS {LEVELS[1]} FROM cementitious)),
j AS (SELECT record_id, a, b, EXISTS (SELECT 1 FROM big WHERE level = 1 AND lower(label) = a) AS pk, EXISTS (SELECT 1 FROM big WHERE level = 2 AND lower(label) = b) AS ck, EXISTS (SELECT 1 FROM big l JOIN big u ON l.parent = u.node WHERE l.level = 2 AND lower(l.label) = b AND lower(u.label) = a) AS ok FROM v)
SELECT record_id, concat_ws('; ', CASE WHEN NOT pk THEN 'unknown parent' END, CASE WHEN b IS NOT NULL AND NOT ck THEN 'unknown child' END, CASE WHEN pk AND ck AND NOT ok THEN 'child of another parent' END) AS errors FROM j WHERE NOT pk OR (b IS NOT NULL AND NOT ck) OR (pk AND ck AND NOT ok)""")
def assignment_errors(spark, d):
    """Records whose branch labels don't fit a tree that lacks one branch's children (a third level where the second should stand is an error)."""
    c = table(spark, d, "cementitious").select("record_id", LEVELS[0], F.when(F.col("record_id").endswith("7"), F.col(LEVELS[2])).otherwise(F.col(LEVELS[1])).alias(LEVELS[1]))
    tree = _tree(spark, d).where("NOT (level = 2 AND node LIKE 'l1\\\\_02/%')")
    return A.assignment_errors(c, "record_id", LEVELS[0], LEVELS[1], tree, 1)


@query(f"""WITH {_TREE}, broken AS (SELECT * FROM tree WHERE node <> 'l1_02' UNION ALL SELECT node || '/x', 'nowhere', level + 1, 'X' FROM tree WHERE level = 4 AND node LIKE 'l1_03/%' UNION ALL SELECT node || '/y', node, level + 1, 'Y' FROM tree WHERE level = 4 AND node LIKE 'l1_04/%'),
j AS (SELECT b.*, u.node AS un, u.level AS ul FROM broken b LEFT JOIN (SELECT DISTINCT node, level FROM broken) u ON b.parent = u.node WHERE b.parent IS NOT NULL)
SELECT DISTINCT * FROM (SELECT 'parent missing' AS error, node FROM j WHERE un IS NULL UNION ALL SELECT 'parent not one level up', node FROM j WHERE ul <> level - 1 UNION ALL SELECT 'leaf with children', parent FROM j WHERE ul >= 4 UNION ALL SELECT 'path twice', node FROM broken GROUP BY node HAVING count(*) > 1
UNION ALL SELECT 'equal sibling slugs', min(node) FROM broken GROUP BY parent, {_LAST.format("node")} HAVING count(DISTINCT node) > 1 UNION ALL SELECT 'several roots', min(node) FROM broken WHERE parent IS NULL HAVING count(*) > 1)""")
def tree_errors(spark, d):
    """What is wrong with a tree that lost a branch's root and got nodes below its leaves."""
    t = _tree(spark, d).drop("aliases")
    leaf = t.where("level = 4")
    lost = leaf.where("node LIKE 'l1\\\\_03/%'").select(F.concat("node", F.lit("/x")), F.lit("nowhere"), F.col("level") + 1, F.lit("X"))
    deep = leaf.where("node LIKE 'l1\\\\_04/%'").select(F.concat("node", F.lit("/y")), F.col("node"), F.col("level") + 1, F.lit("Y"))
    return A.tree_errors(t.where("node <> 'l1_02'").unionAll(lost).unionAll(deep), 4)


@query(f"""WITH m AS (SELECT taxonomy_level_3, min(trim(subcategory)) FILTER ({_has("subcategory")}) AS s, min(trim(category)) FILTER ({_has("category")}) AS c FROM cementitious WHERE taxonomy_level_3 IS NOT NULL GROUP BY 1), r AS (SELECT DISTINCT record_id, taxonomy_level_3, CASE WHEN evidence_origin = 'Web' THEN NULL ELSE subcategory END AS subcategory, category FROM cementitious)
SELECT record_id, coalesce(trim({_known("r.subcategory")}), m.s) AS subcategory, coalesce(trim({_known("r.category")}), m.c) AS category FROM r LEFT JOIN m USING (taxonomy_level_3)""")
def backfilled_assignments(spark, d):
    """Assignments that web records lack, filled from their leaf; never overwritten."""
    c = table(spark, d, "cementitious")
    m = c.where("taxonomy_level_3 IS NOT NULL").groupBy("taxonomy_level_3").agg(F.min(F.trim(known("subcategory"))).alias("subcategory"), F.min(F.trim(known("category"))).alias("category"))
    r = c.select("record_id", "taxonomy_level_3", F.when(F.col("evidence_origin") == "Web", F.lit(None)).otherwise(F.col("subcategory")).alias("subcategory"), "category").distinct()
    return A.backfill(r, ["taxonomy_level_3"], m, ["subcategory", "category"]).select("record_id", "subcategory", "category")


@query(f"SELECT DISTINCT record_id, coalesce(trim({_known('canonical_technology_name')}), raw_technology_name) AS raw_technology_name, coalesce(trim({_known('publication_year')}), project_year) AS project_year FROM cementitious")
def stamped_intents(spark, d):
    """Columns overwritten by newer ones where those hold a value."""
    c = table(spark, d, "cementitious")
    return A.stamp(c, [("raw_technology_name", "canonical_technology_name"), ("project_year", "publication_year")]).select("record_id", "raw_technology_name", "project_year").distinct()


@query(f"WITH {_TREE} SELECT parent, node FROM tree WHERE parent IS NOT NULL AND {_LAST.format('parent')} IN ('l2_05', 'l2_12')")
def selected_scope(spark, d):
    """The leaves that a selection of branches stands for."""
    return A.scope(_tree(spark, d), branches=["l2_05", "l2_12"])


@query("""WITH r AS (SELECT DISTINCT ref_id, list_concat([canonical_name], aliases, [lower(canonical_name), 'waste']) AS ts FROM canonical_names), u AS (SELECT ref_id, unnest(ts) AS t, unnest(range(0, len(ts))) AS i FROM r), f AS (SELECT ref_id, trim(t) AS t, i FROM u WHERE trim(t) <> '' QUALIFY row_number() OVER (PARTITION BY ref_id, lower(trim(t)) ORDER BY i) = 1)
SELECT ref_id, string_agg(t, '|' ORDER BY i) AS terms FROM f GROUP BY 1""")
def distinct_terms(spark, d):
    """Terms of several lists in order, each once without regard to case."""
    r = table(spark, d, "canonical_names")
    return r.select("ref_id", F.array_join(A.distinct_terms(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")), F.array(F.lower("canonical_name"), F.lit("waste"))), "|").alias("terms"))


@query(f"""WITH {_TREE}, c AS (SELECT lower(label) AS l FROM tree WHERE level = 3), s AS (SELECT DISTINCT lower(trim(taxonomy_level_4)) AS l FROM cementitious WHERE {_has("taxonomy_level_4")} UNION SELECT DISTINCT lower(trim(taxonomy_level_3)) FROM cementitious WHERE {_has("taxonomy_level_3")} AND evidence_origin = 'Web')
SELECT 'not mapped' AS side, l AS name FROM (SELECT l FROM c EXCEPT SELECT l FROM s) UNION ALL SELECT 'unknown', l FROM (SELECT l FROM s EXCEPT SELECT l FROM c)""")
def mapping_coverage(spark, d):
    """Nodes that a mapping misses and names that the tree lacks (set differences both ways)."""
    tree = _tree(spark, d).where("level = 3").select(F.lower("label").alias("name")).distinct()
    c = table(spark, d, "cementitious")
    s = c.where(known("taxonomy_level_4").isNotNull()).select(F.lower(F.trim("taxonomy_level_4")).alias("name")).union(c.where((F.col("evidence_origin") == "Web") & known("taxonomy_level_3").isNotNull()).select(F.lower(F.trim("taxonomy_level_3")))).distinct()
    return taxonomy.differences(tree, s, "not mapped", "unknown")
