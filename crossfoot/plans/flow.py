"""Published tables derived from a star schema of orders: who ships what to whom.

origin = nation of the supplier, destination = nation of the customer, category = brand of the part, period = year of
shipping. The five wide tables then relate to each other like independently published ones: a square matrix, a flat
list and three category tables, each with its own printed totals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crossfoot.config import CrosstabSpec
from crossfoot.operators.reshape import flat_list, header_labels, union_all, unpivot_categories, unpivot_matrix
from crossfoot.runtime import materialize, quoted
from crossfoot.sources.crosstab import BODY, FOOTER, reported_totals

TOTAL = "TOTAL"
LABELS = ("code", "description")
SPECS = {
    "matrix": CrosstabSpec("matrix", ("destination",)),
    "summary": CrosstabSpec("summary", LABELS),
    "outward": CrosstabSpec("outward", LABELS),
    "inward": CrosstabSpec("inward", LABELS, total_column=TOTAL),
    "internal": CrosstabSpec("internal", LABELS, total_column=TOTAL),
}
CATEGORY_TABLES = ("outward", "inward", "internal")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flow_rows(spark: SparkSession, sf_dir: str, periods: tuple[int, int] | None = None) -> DataFrame:
    """(origin_key, destination_key, code, period, value): one row per shipped line, five columns of lineitem read.

    ``periods`` (first and last year) becomes a range on the ship date, which the file scan evaluates.
    """
    lines = table(spark, sf_dir, "lineitem")
    if periods:
        first, last = periods
        lines = lines.where(
            (F.col("l_shipdate") >= F.lit(f"{first}-01-01").cast("timestamp"))
            & (F.col("l_shipdate") < F.lit(f"{last + 1}-01-01").cast("timestamp"))
        )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("origin_key"))
    buyers = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey")
        .join(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("destination_key")),
              F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "destination_key")
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("code"))
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "origin_key",
            "destination_key",
            "code",
            F.year("l_shipdate").alias("period"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("value"),
        )
    )


def unresolved_lines(spark: SparkSession, sf_dir: str, parts: Column | None = None, customers: Column | None = None) -> DataFrame:
    """(reason, n_lines, value) of lines that refer to an absent row; ``flow_rows`` leaves such lines out.

    A line with several reasons counts for each. ``parts`` and ``customers`` restrict what counts as present. All
    references are resolved from the left in one pass over the lines, and one aggregate counts them.
    """
    part = table(spark, sf_dir, "part").filter(F.lit(True) if parts is None else parts).select("p_partkey").distinct()
    nations = table(spark, sf_dir, "nation").select("n_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(nations.withColumnRenamed("n_nationkey", "from_key"), F.col("s_nationkey") == F.col("from_key"), "left")
    customer = table(spark, sf_dir, "customer").filter(F.lit(True) if customers is None else customers).select("c_custkey", "c_nationkey")
    customer = customer.join(nations.withColumnRenamed("n_nationkey", "to_key"), F.col("c_nationkey") == F.col("to_key"), "left")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("value"))
    met = (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    )
    absent = {
        "part": "p_partkey IS NULL",
        "supplier": "s_suppkey IS NULL",
        "order": "o_orderkey IS NULL",
        "customer": "o_orderkey IS NOT NULL AND c_custkey IS NULL",
        "origin": "s_suppkey IS NOT NULL AND from_key IS NULL",
        "destination": "c_custkey IS NOT NULL AND to_key IS NULL",
    }
    sums = [F.struct(F.count_if(F.expr(c)).alias("n_lines"), F.coalesce(F.sum(F.expr(f"if({c}, value, 0)")), F.lit(0)).cast("double").alias("value")).alias(name) for name, c in absent.items()]
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("reason"), F.col(f"{name}.n_lines"), F.round(f"{name}.value", 2).alias("value")) for name in absent]))
    return met.agg(*sums).select(rows.alias("row")).select("row.*")


def flow_cube(
    spark: SparkSession, sf_dir: str, periods: tuple[int, int] | None = None, by_period: bool = False
) -> DataFrame:
    """(origin, destination, code, [period,] value): sums of :func:`flow_rows`.

    Keys stay integers up to the aggregate; names are attached to its few rows.
    """
    kept = ["code", "period"] if by_period else ["code"]
    cube = flow_rows(spark, sf_dir, periods).groupBy("origin_key", "destination_key", *kept).agg(F.sum("value").alias("value"))
    nations = table(spark, sf_dir, "nation")
    for side in ("origin", "destination"):
        names = nations.select(F.col("n_nationkey").alias(f"{side}_key"), F.col("n_name").alias(side))
        cube = cube.join(names, f"{side}_key")
    return cube.select("origin", "destination", *kept, "value")


def category_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, description) of every category."""
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("code")).agg(F.min("p_type").alias("description"))


def entity_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity) of every nation."""
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("entity")).distinct()


# Where one cube row goes: (table, row label, row role, column label) as SQL text.
def _places() -> str:
    def cells(name: str, entity: str) -> list[str]:
        columns = [entity, f"'{TOTAL}'"] if SPECS[name].total_column else [entity]
        rows = (("code", BODY), (f"'{TOTAL}'", FOOTER))
        return [_place(name, row, role, column) for row, role in rows for column in columns]

    always = [_place("matrix", "destination", BODY, "origin")]
    always += [_place("summary", row, role, f"'{TOTAL}'") for row, role in (("code", BODY), (f"'{TOTAL}'", FOOTER))]
    crossing = ", ".join(cells("outward", "origin") + cells("inward", "destination"))
    own = ", ".join(cells("internal", "origin"))
    return f"inline(concat(array({', '.join(always)}), if(origin <> destination, array({crossing}), array({own}))))"


def _place(name: str, row: str, role: str, column: str) -> str:
    return f"struct('{name}' AS table_name, {row} AS row, '{role}' AS row_role, {column} AS column)"


def _printed(name: str) -> str:
    """Cell as printed, as SQL text: a published total is never blank, a body cell may be."""
    with_total = ", ".join(f"'{table}'" for table, spec in SPECS.items() if spec.total_column)
    printed = f"row_role = '{FOOTER}'" + (f" OR table_name IN ({with_total})" if name == TOTAL else "")
    return f"if({printed}, coalesce({quoted(name)}, 0), {quoted(name)}) AS {quoted(name)}"


def _row_dimension(entities: DataFrame, categories: DataFrame) -> DataFrame:
    """(table_name, row, description, row_role) of every printed row."""
    names = F.array(*[F.lit(name) for name in SPECS if name != "matrix"])
    footers = entities.sparkSession.range(1).select(F.lit(TOTAL).alias("row"), F.lit(TOTAL).alias("description"), F.lit(FOOTER).alias("row_role"))
    bodies = categories.select(F.col("code").alias("row"), "description", F.lit(BODY).alias("row_role"))
    by_code = bodies.unionByName(footers).select(F.explode(names).alias("table_name"), "row", "description", "row_role")
    by_entity = entities.select(
        F.lit("matrix").alias("table_name"), F.col("entity").alias("row"), F.lit("").alias("description"), F.lit(BODY).alias("row_role")
    )
    return by_code.unionByName(by_entity)


@dataclass(frozen=True)
class Published:
    """Wide tables as a publisher would print them, with the dimensions that span them."""

    wide: dict[str, DataFrame]
    entities: DataFrame
    categories: DataFrame
    labels: list[str]

    def long(self) -> dict[str, DataFrame]:
        """The five long tables; blank cells are rows with NULL."""
        return {
            "matrix": unpivot_matrix(self.wide["matrix"], SPECS["matrix"]),
            "summary": flat_list(self.wide["summary"], SPECS["summary"], "value"),
            **{name: unpivot_categories(self.wide[name], SPECS[name]) for name in CATEGORY_TABLES},
        }

    def totals(self) -> DataFrame:
        """All published totals."""
        frames = [reported_totals(self.wide["summary"], SPECS["summary"], flat_value="value")]
        return union_all(frames + [reported_totals(self.wide[name], SPECS[name]) for name in CATEGORY_TABLES])


def publish(cube: DataFrame, entities: DataFrame, categories: DataFrame, snapshots: list[int] | None = None) -> list[Published]:
    """Published tables of the whole cube, or of each period in ``snapshots``.

    Every cube row is placed into all tables it belongs to and one grouping prints them all: the joins behind the cube
    run once, whatever is asked of the tables later. The printed rows are written once. Each table has a row per
    category (or entity) even where the cube has no data.
    """
    labels = header_labels(entities, "entity")
    header = [*labels, TOTAL]
    label = F.col("period") if snapshots else F.lit(0)
    keys = ["snapshot", "table_name", "row", "row_role"]
    placed = cube.select(label.alias("snapshot"), "origin", "destination", "code", "value").select(
        "snapshot", "value", F.expr(_places())
    )
    sums = placed.groupBy(*keys).pivot("column", header).agg(F.sum("value"))
    numbers = F.array(*[F.lit(number) for number in snapshots or [0]])
    rows = _row_dimension(entities, categories).select(F.explode(numbers).alias("snapshot"), "*")
    printed = materialize(
        rows.join(sums, keys, "left").selectExpr(*keys, "description", *[_printed(name) for name in header])
    )

    def one(number: int) -> Published:
        def take(name: str, *columns: str) -> DataFrame:
            return printed.where((F.col("snapshot") == number) & (F.col("table_name") == name)).selectExpr(*columns)

        cells = [quoted(name) for name in labels]
        fixed = ("row AS code", "description", "row_role")
        wide = {
            "matrix": take("matrix", "row AS destination", *cells),
            "summary": take("summary", *fixed, f"{TOTAL} AS value"),
            "outward": take("outward", *fixed, *cells),
            "inward": take("inward", *fixed, *cells, TOTAL),
            "internal": take("internal", *fixed, *cells, TOTAL),
        }
        known = wide["summary"].where(F.col("row_role") == BODY).select("code", "description")
        return Published(wide, wide["matrix"].select(F.col("destination").alias("entity")), known, labels)

    return [one(number) for number in snapshots or [0]]


def published(spark: SparkSession, sf_dir: str, periods: tuple[int, int] | None = None) -> Published:
    """Published tables of all periods, or of a range of them, in one go."""
    cube = flow_cube(spark, sf_dir, periods)
    return publish(cube, entity_dimension(spark, sf_dir), category_dimension(spark, sf_dir))[0]


def published_snapshots(spark: SparkSession, sf_dir: str, reference: int, comparison: int) -> tuple[Published, Published]:
    """Published tables of two years; the joins run once for both."""
    cube = flow_cube(spark, sf_dir, (min(reference, comparison), max(reference, comparison)), by_period=True)
    before, after = publish(cube, entity_dimension(spark, sf_dir), category_dimension(spark, sf_dir), [reference, comparison])
    return before, after
