"""Inputs of the registered queries, shaped from the flat tables.

The nested rows stand for documents that arrive nested: an entry per order, a record per
customer. A nested document is one row by its nature, so its parts are gathered by the
document's own key, whatever their number (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kinweave.operators.nested import enrich_tree, laureate_lookup, scholar_lookup
from kinweave.operators.reshape import entity_ids
from kinweave.schemas import AFFILIATION_FIELDS, PLACE_FIELDS
from kinweave.session import materialise

_SCHEMAS: dict[str, StructType] = {}
# Suppliers are sent to the order lines up to this many rows.
SMALL_SUPPLIERS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file footer the first time only."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order, supplier, line) of every order line; ``line`` is its place in the order."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", F.struct("l_linenumber", "l_suppkey", "l_partkey").alias("line")
    )


def _in_line_order(item: Column) -> Column:
    """The items of a group by line; rows without a line give no item."""
    placed = F.when(F.col("line").isNotNull(), F.struct("line", item.alias("item")))
    return F.transform(F.sort_array(F.collect_list(placed)), lambda x: x["item"])


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree entries: the customer of an order is the child, its suppliers the parents."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    places = ["l_linenumber", "l_suppkey", "l_partkey"]
    lines = (
        table(spark, sf_dir, "lineitem")
        .filter("l_orderkey IS NOT NULL")
        .select("l_orderkey", *places)
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    # A list holds the place and the name of a line; what is the same in all parents is added
    # to the sorted list. The shuffle by order serves the join too.
    lists = (
        lines.repartition("l_orderkey")
        .groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_list(F.struct(*places, "s_name"))).alias("lines"))
    )
    nothing = F.lit(None)

    def parent(line: Column) -> Column:
        return F.struct(
            line["s_name"].alias("name"),
            F.lit("scholar").alias("type"),
            nothing.cast("string").alias("category"),
            nothing.cast("int").alias("year"),
        )

    none = F.array().cast(lists.schema["lines"].dataType)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    child = F.struct(
        F.col("c_name").alias("name"),
        F.lit("laureate").alias("type"),
        F.col("c_mktsegment").alias("category"),
        F.year("o_orderdate").alias("year"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Customers meet the flat orders, not the nested entries.
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").cast("string").alias("entry_id"),
            F.array(child).alias("children"),
            F.transform(F.coalesce("lines", none), parent).alias("parents"),
        )
    )


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping records: customers with a balance are resolved, the others are not."""
    return (
        table(spark, sf_dir, "customer")
        .filter("c_acctbal >= 0")
        .select(
            F.struct(
                F.col("c_name").alias("name"),
                F.col("c_mktsegment").alias("category"),
                F.lit(None).cast("string").alias("year"),
            ).alias("source"),
            F.struct(
                F.col("c_custkey").alias("id"),
                F.col("c_name").alias("knownName"),
                F.col("c_name").alias("fullName"),
                F.col("c_mktsegment").alias("category"),
            ).alias("matched_record"),
            F.lit("high").alias("confidence"),
            F.col("c_custkey").alias("position"),
        )
    )


def tree_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = materialise(tree(spark, sf_dir), "entries")
    ids = entity_ids(entries)
    lookup = laureate_lookup(mapping(spark, sf_dir), "position").unionByName(
        scholar_lookup(ids.withColumn("n", F.expr("cast(substr(id, 2) as long)")), "n")
    )
    return enrich_tree(entries, lookup, "entry_id")


def _pick(key: Column, values: list[str]) -> Column:
    """The value at position ``key mod n``."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(key, F.lit(len(values))).cast("int"))


# Categories given to orders, in turn.
CATEGORIES = ["Physics", "Chemistry", "Physiology or Medicine", "Economic Sciences", "Peace"]


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference records: a customer with its orders as prizes."""
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(_places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "s_name", "s_nationkey", "n_name", "r_name")
    )
    city = F.concat(F.lit("City "), F.col("s_nationkey").cast("string"))
    spelling = F.pmod("s_suppkey", F.lit(3))
    city = (
        F.when(spelling == 0, city)
        .when(spelling == 1, F.concat(city, F.lit(", "), "r_name"))
        .otherwise(F.concat(city, F.lit(", "), "r_name", F.lit(", X")))
    )
    texts = {
        "name": F.col("s_name"),
        "nameNow": F.col("s_name"),
        "city": city,
        "country": F.col("n_name"),
        "cityNow": city,
        "countryNow": F.col("n_name"),
        "continent": F.col("r_name"),
    }
    affiliation = F.struct(*[texts[f].alias(f) for f in AFFILIATION_FIELDS])
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    amount = F.floor("o_totalprice").cast("long")
    prize = F.struct(
        F.year("o_orderdate").cast("string").alias("awardYear"),
        _pick(F.col("o_orderkey"), CATEGORIES).alias("category"),
        # Several portions of one prize and person, so that it matters which of them wins.
        F.concat(F.lit("1/"), (F.pmod("o_orderkey", F.lit(4)) + 1).cast("string")).alias("portion"),
        day.alias("dateAwarded"),
        F.col("o_orderpriority").alias("motivation"),
        amount.alias("prizeAmount"),
        (amount * 2).alias("prizeAmountAdjusted"),
        F.col("affiliations"),
        F.col("o_orderkey").alias("o_orderkey"),
    )
    columns = ["o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice"]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", *columns)
    # Orders are dealt to their customers with the keys of their lines; the texts of a line are
    # looked up there and not shuffled, as all that follows is grouped within a customer.
    lines = order_lines(spark, sf_dir)
    of_orders = (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("o_orderkey")
        .agg(
            *[F.any_value(c).alias(c) for c in columns],
            F.collect_list(F.when(F.col("line").isNotNull(), F.struct("line", "l_suppkey"))).alias("lines"),
        )
        .repartition("o_custkey")
        .select("o_orderkey", *columns, F.explode_outer("lines").alias("at"))
        .select("o_orderkey", *columns, "at.line", "at.l_suppkey")
    )
    if table(spark, sf_dir, "supplier").count() <= SMALL_SUPPLIERS:
        suppliers = F.broadcast(suppliers)
    found = of_orders.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    # A line of an unknown supplier is no affiliation.
    found = found.withColumn("line", F.when(F.col("s_suppkey").isNotNull(), F.col("line")))
    prizes = (
        found.groupBy("o_custkey", "o_orderkey")
        .agg(
            *[F.any_value(c).alias(c) for c in columns if c != "o_custkey"],
            _in_line_order(affiliation).alias("affiliations"),
        )
        .groupBy("o_custkey")
        .agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("o_orderkey", prize.alias("p")))),
                lambda x: x["p"],
            ).alias("prizes")
        )
    )
    records = people(spark, sf_dir, keep=["c_custkey"])
    # The records without prizes are the side that is held; the nested rows stream past it.
    joined = records.hint("shuffle_hash").join(prizes, F.col("c_custkey") == F.col("o_custkey"), "left")
    none = F.array().cast(joined.schema["prizes"].dataType)
    columns = [c for c in records.columns if c != "c_custkey"]
    return joined.select(*columns, F.coalesce("prizes", none).alias("prizes"))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )


def people(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """Reference records without their prizes: what a customer alone gives. ``keep`` carries more
    columns of the customer."""
    records = table(spark, sf_dir, "customer").join(
        _places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    home = F.concat(F.lit("City "), F.col("c_nationkey").cast("string"))
    known = F.pmod("c_nationkey", F.lit(5)) != 0
    born = F.concat(F.lit("19"), F.lpad(F.pmod("c_custkey", F.lit(90)).cast("string"), 2, "0"))
    dates = [F.lit("1898-00-00"), F.lit("1898-07-00"), F.lit("garbage"), F.lit("")]
    date = F.concat(born, F.lit("-02-03"))
    for i, value in enumerate(dates):
        date = F.when(F.pmod("c_custkey", F.lit(7)) == i, value).otherwise(date)
    return records.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("knownName"),
        F.lit(None).cast("string").alias("givenName"),
        F.lit(None).cast("string").alias("familyName"),
        F.col("c_name").alias("fullName"),
        _pick(F.col("c_custkey"), ["female", "male"]).alias("gender"),
        date.alias("birthDate"),
        F.when(F.pmod("c_custkey", F.lit(2)) == 0, F.concat(home, F.lit(", "), "r_name"))
        .otherwise(home)
        .alias("birthPlaceCity"),
        F.when(known, F.col("n_name")).alias("birthPlaceCountry"),
        home.alias("birthPlaceCityNow"),
        F.when(known, F.col("n_name")).alias("birthPlaceCountryNow"),
        F.col("r_name").alias("birthPlaceContinent"),
        F.lit(None).cast("string").alias("deathDate"),
        *(keep or []),
    )


def _en(column: Column) -> Column:
    return F.struct(column.alias("en"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records: the reference records before their language tags were removed. The
    category of each 13th order is NULL."""
    ref = reference(spark, sf_dir)

    def affiliation(a: Column) -> Column:
        return F.struct(*[_en(a[f]).alias(f) for f in AFFILIATION_FIELDS])

    def prize(p: Column) -> Column:
        category = F.when(F.pmod(p["o_orderkey"], F.lit(13)) != 0, p["category"])
        return F.struct(
            p["awardYear"].alias("awardYear"),
            _en(category).alias("category"),
            p["portion"].alias("portion"),
            p["dateAwarded"].alias("dateAwarded"),
            _en(p["motivation"]).alias("motivation"),
            p["prizeAmount"].alias("prizeAmount"),
            p["prizeAmountAdjusted"].alias("prizeAmountAdjusted"),
            F.transform(p["affiliations"], affiliation).alias("affiliations"),
        )

    place = F.struct(
        *[_en(F.col("birthPlace" + f[0].upper() + f[1:])).alias(f) for f in PLACE_FIELDS]
    )
    return ref.select(
        "id",
        *[_en(F.col(f)).alias(f) for f in ("knownName", "givenName", "familyName", "fullName")],
        "gender",
        F.struct(F.col("birthDate").alias("date"), place.alias("place")).alias("birth"),
        F.struct(F.col("deathDate").alias("date")).alias("death"),
        F.transform("prizes", prize).alias("nobelPrizes"),
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct whole texts per language, under the smallest id of their copies."""
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "lang", F.lower("text").alias("text"))
        .groupBy("lang", "text")
        .agg(F.min("doc_id").alias("doc_id"))
    )
