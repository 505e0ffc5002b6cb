"""The feature taxonomy as two tables: nodes (name, label, parent, depth, description) and features (node, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import _c, slug_title
from millrace.operators import allocate, joins

#: The baseline roots: name, label, description and children (fixed values).
BASELINE = [
    ("metaprogramming", "Metaprogramming", "Macros, code generation, syntax extension", "macros code-generation syntax-extension macro-utilities"),
    ("polymorphism", "Polymorphism & Dispatch", "Protocols, multimethods, hierarchies, type-based dispatch", "protocols multimethods records types hierarchies"),
    ("concurrency", "Concurrency & State", "Atoms, refs, agents, core.async, futures, promises", "atoms-refs core-async agents futures-promises stm"),
    ("data-transformation", "Data Transformation", "Transducers, sequence operations, data manipulation, spec validation", "transducers sequences spec-validation data-coercion collection-ops"),
    ("interop", "Java/Platform Interop", "JVM interop, host calls, proxy, gen-class, native access", "jvm-interop host-calls proxy-gen-class native"),
    ("web-http", "Web & HTTP", "Ring handlers, middleware, routing, HTTP clients, servers", "ring-handlers middleware routing http-clients servers websockets"),
    ("data-storage", "Data Storage & Retrieval", "Database access, queries, caching, EDN serialization", "sql queries caching serialization datomic"),
    ("repl-development", "REPL-Driven Development", "Interactive evaluation, rich comments, REPL tooling, exploration patterns", "interactive-eval rich-comments repl-tooling exploration hot-reload"),
    ("testing", "Testing & Verification", "Unit tests, property-based testing, generative testing, assertions", "unit-tests property-tests generative-tests asserts fixtures"),
    ("error-handling", "Error Handling & Resilience", "Exceptions, error monads, validation chains, retries, circuit breakers", "exceptions error-monads validation retry circuit-breaker"),
    ("configuration", "Configuration & Lifecycle", "Component systems, integrant, mount, config management", "component integrant mount config-management lifecycle"),
    ("data-structures", "Custom Data Structures", "Custom collections, lazy sequences, zippers, trees, graphs", "custom-collections lazy-sequences zippers trees graphs"),
]
NODE = "name string, label string, description string, parent string, depth int"


def baseline(spark: SparkSession) -> DataFrame:
    """The roots at depth 0 and their children at depth 1, labelled by X60."""
    roots = [(n, label, about, None, 0) for n, label, about, _ in BASELINE]
    kids = [(k, None, "", n, 1) for n, _, _, ks in BASELINE for k in ks.split()]
    return spark.createDataFrame(roots + kids, NODE).withColumn("label", F.coalesce("label", slug_title("name")))


def assigned(nodes: DataFrame, features: DataFrame, table: DataFrame, default: str) -> DataFrame:
    """Features (feature_type, name, description) with `category` and `node`, the best child of it."""
    routed = joins.routed(features, table, "feature_type", default)
    kids = nodes.filter("depth > 0").select("parent", F.col("name").alias("child"), F.xxhash64("name").alias("ord"))
    text = routed.withColumn("_t", F.concat_ws(" ", "name", "description"))
    return joins.best_child(text, kids, "category", "_t").withColumnRenamed("child", "node").drop("_t")


def statistics(nodes: DataFrame, features: DataFrame) -> DataFrame:
    """Of each root its own and its children's features; one row more for all."""
    counted = allocate.coverage(nodes, features.select(F.col("node").alias("name")), "name")
    return counted.withColumn("root", F.coalesce("parent", "name")).rollup("root").agg(F.count(F.lit(1)).alias("nodes"), F.sum("n_features").alias("features"))


def diversity(nodes: DataFrame, features: DataFrame) -> DataFrame:
    """A6 over nodes below the roots."""
    counted = allocate.coverage(nodes.filter("depth >= 1"), features.select(F.col("node").alias("name")), "name")
    return allocate.normalised_entropy(counted, "n_features")


def to_json(nodes: DataFrame) -> DataFrame:
    """The tree, a map of name to node with its children in order of name, as one JSON text. A taxonomy is small."""
    kids = nodes.groupBy(F.col("parent").alias("name")).agg(F.array_sort(F.collect_list("name")).alias("children"))
    full = nodes.join(kids, "name", "left").withColumn("children", F.coalesce("children", F.array().cast("array<string>")))
    entry = F.struct("name", F.struct("label", "description", "parent", "depth", "children").alias("node"))
    return full.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("tree"))


def from_json(tree: DataFrame, column: str = "tree") -> DataFrame:
    """The node table of Y11's text."""
    kind = "map<string,struct<label:string,description:string,parent:string,depth:int,children:array<string>>>"
    rows = tree.select(F.explode(F.from_json(F.col(column), kind)).alias("name", "n"))
    return rows.select("name", "n.label", "n.description", "n.parent", "n.depth")


def with_defaults(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The fields with their defaults where a column is missing or null."""
    return df.select(*[F.coalesce(F.col(k), F.lit(v)).alias(k) if k in df.columns else F.lit(v).alias(k) for k, v in fields.items()])


def descendants(spark: SparkSession, nodes: DataFrame, root: str) -> DataFrame:
    """All nodes below a root, by a recursive query."""
    nodes.createOrReplaceTempView("millrace_nodes")
    return spark.sql(
        "WITH RECURSIVE t(name, level) AS (SELECT name, 0 FROM millrace_nodes WHERE name = :root UNION ALL SELECT n.name, level + 1 FROM millrace_nodes n JOIN t ON n.parent = t.name) SELECT * FROM t",
        {"root": root},
    )


def lookup(log: DataFrame, steps: DataFrame, step: str = "step") -> DataFrame:
    """The loss of exactly these steps."""
    return steps.join(log, step, "left")


def environment(x: Column | str, values: dict[str, str]) -> Column:
    """${NAME} by its value; unknown names are empty."""
    out = _c(x)
    for k, v in values.items():
        out = F.replace(out, F.lit("${" + k + "}"), F.lit(v))
    return F.regexp_replace(out, r"\$\{\w+\}", "")
