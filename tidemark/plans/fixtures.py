"""Catalogue tables derived from the driver's tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import effective_priority
from tidemark.operators.ordered import Running, running
from tidemark.operators.sizes import spread
from tidemark.session import IDS, cut_lineage

LANGUAGES = {1: "en", 2: "de", 3: "fr"}
PARTKEYS_PER_CHUNK = 1 << 22


def micros(c: Column | str) -> Column:
    """Epoch microseconds of a zone-less time."""
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


class Fixtures:
    """The tables of one folder and the views over them; each is built once and lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def languages(self) -> DataFrame:
        rows = ", ".join(f"({i}, '{name}', {int(name == 'de')})" for i, name in LANGUAGES.items())
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS t(ID, ShortName, IsDefault)")

    @cached_property
    def items(self) -> DataFrame:
        """Parts in three languages, with attributes 13 (brand), 43 (type) and 44 (size)."""
        return self._items(self.table("part"))

    @staticmethod
    def _items(parts: DataFrame) -> DataFrame:
        size, key = F.col("p_size"), F.col("p_partkey")
        parent = F.floor(key / 10).cast("bigint")
        names = F.create_map(*[F.lit(x) for pair in LANGUAGES.items() for x in pair])

        def attribute(i: int, value: Column, formatted: Column) -> list[Column]:
            return [F.lit(i).cast("bigint"), F.struct(value.alias("value"), formatted.alias("formatted"))]

        attrs = F.create_map(
            *attribute(13, F.col("p_brand"), F.col("p_brand")),
            *attribute(43, F.col("p_type"), F.lower("p_type")),
            *attribute(44, text(size), F.concat(text(size), F.lit(" kg"))),
        )
        rows = parts.withColumn("LanguageID", F.explode(F.array(*[F.lit(i) for i in LANGUAGES])))
        short = names[F.col("LanguageID")]
        return rows.select(
            (key + 1).alias("ID"),
            F.col("LanguageID").cast("bigint").alias("LanguageID"),
            short.alias("LanguageShortName"),
            F.concat("p_name", F.lit(" ["), short, F.lit("]")).alias("Label"),
            parent.alias("ParentID"),
            F.when(size % 5 == 0, 1).otherwise(0).alias("IsFolder"),
            F.format_string(" %d %d ", 100 + size % 5, 200 + size % 7).alias("ClassMapping"),
            F.format_string(" %d %d ", parent, key + 1).alias("_Parents"),
            size.cast("bigint").alias("StateID"),
            (size % 4).cast("bigint").alias("WorkflowID"),
            (size % 10).cast("bigint").alias("AuthorID"),
            F.concat(F.lit("user"), text(size % 10)).alias("Author"),
            F.concat(F.lit("P-"), text(key + 1)).alias("ExternalKey"),
            (key % 3).alias("CopyOf"),
            (size % 6).cast("bigint").alias("CheckoutUser"),
            F.date_add(F.lit("1998-01-01").cast("date"), size).cast("timestamp").alias("CreationDate"),
            F.date_add(F.lit("1999-01-01").cast("date"), size * 7).cast("timestamp").alias("LastChange"),
            attrs.alias("attrs"),
        )

    @cached_property
    def item_fields(self) -> DataFrame:
        """Items as message fields: ID, LanguageID and a map of text. Building the maps is the work, so all cores take part."""
        attrs = F.map_entries("attrs")
        pairs = F.flatten(
            F.transform(
                attrs,
                lambda e: F.array(
                    F.struct(F.concat(text(e["key"]), F.lit(":Value")).alias("k"), e["value"]["value"].alias("v")),
                    F.struct(
                        F.concat(text(e["key"]), F.lit(":FormattedValue")).alias("k"),
                        e["value"]["formatted"].alias("v"),
                    ),
                ),
            )
        )
        own = F.array(
            *[
                F.struct(F.lit(c).alias("k"), text(c).alias("v"))
                for c in ("ID", "LanguageID", "Label", "ClassMapping", "StateID", "WorkflowID", "ExternalKey", "_Parents")
            ],
            F.struct(F.lit("CheckoutUser").alias("k"), F.when(F.col("CheckoutUser") > 0, text("CheckoutUser")).alias("v")),
        )
        items = self._items(spread(self.table("part")))
        return items.select("ID", "LanguageID", F.map_from_entries(F.concat(own, pairs)).alias("fields"))

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with a row key, numbered per order without gathering an order in one task."""
        order = [
            "l_partkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus",
        ]
        numbered = running(
            self.table("lineitem"), ["l_orderkey"], [F.col(c) for c in order],
            F.floor(F.col("l_partkey") / PARTKEYS_PER_CHUNK), Running("__n", "count"),
        )
        return numbered.select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_quantity",
            (F.col("l_orderkey") * 1000 + F.col("__n")).alias("line_id"),
        )

    def _reference_columns(self) -> list[Column]:
        return [
            F.lit(2).cast("bigint").alias("LanguageID"),
            (30 + F.col("l_linenumber") % 3).cast("bigint").alias("AttributeID"),
            F.col("line_id").alias("ReferenceID"),
        ]

    @cached_property
    def references(self) -> DataFrame:
        """Order → part."""
        return self.lines.select(
            F.col("l_orderkey").alias("ItemID"),
            F.lit("Order").alias("SourceType"),
            *self._reference_columns(),
            F.col("l_orderkey").alias("_SubitemID"),
            (F.col("l_partkey") + 1).alias("TargetID"),
            F.lit("Part").alias("TargetType"),
            F.col("l_linenumber").cast("bigint").alias("SortOrder"),
        )

    @cached_property
    def order_lines(self) -> DataFrame:
        return self.lines.join(
            self.table("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
        )

    def stored(self) -> Fixtures:
        """The same views over order lines written out once, for queries that scan them several times."""
        copy = Fixtures(self.spark, self.sf_dir)
        copy.__dict__["order_lines"] = cut_lineage(
            self.order_lines.select("o_orderkey", "o_custkey", "l_partkey", "l_linenumber", "l_returnflag", "line_id"), **IDS
        )
        return copy

    @cached_property
    def row_references(self) -> DataFrame:
        """References held by the order rows nested in a customer."""
        return self.order_lines.select(
            F.col("o_custkey").alias("ItemID"),
            F.lit("Customer").alias("SourceType"),
            *self._reference_columns(),
            (F.col("o_orderkey") + 1000000).alias("_SubitemID"),
            (F.col("l_partkey") + 1).alias("TargetID"),
            F.lit("Part").alias("TargetType"),
            F.col("l_linenumber").cast("bigint").alias("SortOrder"),
        )

    @cached_property
    def subtables(self) -> DataFrame:
        """Customer → order rows (191) → line rows (192) → rows below some lines (193) → rows below these (194)."""
        shared = [F.lit("Customer").alias("ItemType"), F.lit(2).cast("bigint").alias("LanguageID")]
        top = self.table("orders").select(
            F.col("o_custkey").alias("ItemID"), *shared, F.lit(191).cast("bigint").alias("AttributeID"),
            (F.col("o_orderkey") + 1000000).alias("ItemTableID"), F.col("o_custkey").alias("_SubitemID"),
            F.lit(0).cast("bigint").alias("SortOrder"), F.col("o_orderstatus").alias("Value"),
        )
        nested = self.order_lines.select(
            F.col("o_custkey").alias("ItemID"), *shared, F.lit(192).cast("bigint").alias("AttributeID"),
            (F.col("line_id") + 1000000000).alias("ItemTableID"), (F.col("o_orderkey") + 1000000).alias("_SubitemID"),
            F.col("l_linenumber").cast("bigint").alias("SortOrder"), F.col("l_returnflag").alias("Value"),
        )
        # Further levels below some lines: 193 below every other one, 194 below every other of these.
        number = F.col("l_linenumber")

        def deeper(kind: int, base: int, below: int, step: int) -> DataFrame:
            return self.order_lines.where(number % step == 1).select(
                F.col("o_custkey").alias("ItemID"), *shared, F.lit(kind).cast("bigint").alias("AttributeID"),
                (F.col("line_id") + F.lit(base)).alias("ItemTableID"),
                (F.col("line_id") + F.lit(below)).alias("_SubitemID"), F.lit(0).cast("bigint").alias("SortOrder"),
                F.concat("l_returnflag", F.lit(str(kind))).alias("Value"),
            )

        third = deeper(193, 10_000_000_000_000, 1_000_000_000, 2)
        fourth = deeper(194, 20_000_000_000_000, 10_000_000_000_000, 4)
        return top.unionByName(nested).unionByName(third).unionByName(fourth)

    @staticmethod
    def as_changes(events: DataFrame) -> DataFrame:
        """Events as change-log rows; works on a stream as well."""
        kind, event = F.col("event_type"), F.col("event_id")
        return events.select(
            (event + F.when(event % 5 == 0, 40).otherwise(0)).alias("seq"),
            "event_id",
            F.col("user_id").alias("ID"),
            micros("ts").alias("InsertTime"),
            F.when((kind == "error") & (event % 50 == 0), 2).when(kind == "signup", 3).otherwise(1).alias("Action"),
            F.when(kind == "purchase", 0).when(kind == "view", 2).when(kind == "click", 3).otherwise(4)
            .alias("JMSPriority"),
            ((event % 4) * 2).cast("int").alias("ProducerStatus"),
            F.col("props").alias("Message"),
            "event_type",
            # Types share ids.
            F.when((F.col("user_id") + event % 2) % 4 == 0, "Pdmarticle")
            .when((F.col("user_id") + event % 2) % 4 == 1, "Pdmarticlestructure")
            .when((F.col("user_id") + event % 2) % 4 == 2, "Mamfile")
            .otherwise("User")
            .alias("item_type"),
            F.when(event % 7 == 0, "Configuration")
            .when(event % 7 == 1, "Mapping")
            .when(event % 7 == 2, "FileContent")
            .otherwise("Item")
            .alias("type"),
        )

    @cached_property
    def changes(self) -> DataFrame:
        return self.as_changes(self.table("events"))

    @cached_property
    def sent(self) -> DataFrame:
        return self.changes.withColumn("sent_priority", effective_priority("JMSPriority", "type"))

    @cached_property
    def subscriptions(self) -> DataFrame:
        return self.changes.groupBy(
            F.concat(F.lit("consumer-"), text("ID")).alias("SubscriberName"),
            F.concat_ws("/", "item_type", "type").alias("ItemType"),
        ).agg(F.min(2 + 2 * F.floor(F.col("ID") % 8 / 4)).alias("ProducerID"))

    @cached_property
    def order_items(self) -> DataFrame:
        """Orders as items of the default language."""
        status = F.col("o_orderstatus")
        written = F.col("o_orderdate").cast("timestamp")
        return self.table("orders").select(
            F.col("o_orderkey").alias("ID"),
            F.lit(2).cast("bigint").alias("LanguageID"),
            F.lit("de").alias("LanguageShortName"),
            F.col("o_orderpriority").alias("Label"),
            F.col("o_custkey").alias("ParentID"),
            F.when(status == "O", 10).when(status == "F", 60).otherwise(40).cast("bigint").alias("StateID"),
            (F.col("o_custkey") % 4).alias("WorkflowID"),
            F.concat(F.lit("O-"), text("o_orderkey")).alias("ExternalKey"),
            (F.col("o_custkey") % 5).alias("CopyOf"),
            F.format_string(" %d ", 300 + F.col("o_custkey") % 3).alias("ClassMapping"),
            written.alias("_LastWritten"),
            (written - F.expr("INTERVAL 30 DAY")).alias("_InsertTime"),
        )

    @cached_property
    def attributes(self) -> DataFrame:
        """Region folders → nation folders → suppliers as attributes."""
        key = F.col("s_suppkey")

        def row(ident, parent, label, external, folder, link, kind, props, a, b) -> list[Column]:
            return [
                ident.cast("bigint").alias("ID"), parent.cast("bigint").alias("ParentID"), F.col(label).alias("Label"),
                external.alias("ExternalKey"), F.lit(folder).alias("IsFolder"), link.cast("int").alias("IsLink"),
                kind.cast("int").alias("_TypeID"), props.alias("PropertyValues"), a.alias("ParamA"), b.alias("ParamB"),
            ]

        none = F.lit("")
        regions = self.table("region").select(
            *row(1 + F.col("r_regionkey"), F.lit(0), "r_name", none, 1, F.lit(0), F.lit(0), none, none, none)
        )
        nations = self.table("nation").select(
            *row(100 + F.col("n_nationkey"), 1 + F.col("n_regionkey"), "n_name",
                 F.concat(F.lit("N-"), text("n_nationkey")), 1, F.lit(0), F.lit(0), none, none, none)
        )
        suppliers = self.table("supplier").select(
            *row(1000 + key, 100 + F.col("s_nationkey"), "s_name",
                 F.when(key % 13 != 0, F.concat(F.lit("S-"), text(key - key % 2))), 0,
                 F.when(key % 11 == 0, 1).otherwise(0), 1 + key % 3,
                 F.format_string('{"unit":"u%d","decimals":%d}', key % 9, key % 4),
                 F.concat(F.lit("a"), text(key)), F.concat(F.lit("b"), text("s_nationkey")))
        )
        return regions.unionByName(nations).unionByName(suppliers)

    @cached_property
    def class_attributes(self) -> DataFrame:
        nation = F.col("n_nationkey")
        pairs = F.concat(
            F.array(
                F.struct((100 + nation % 5).alias("c"), (10 + nation).alias("a")),
                F.struct((200 + nation % 7).alias("c"), (10 + nation).alias("a")),
                F.struct((400 + nation % 2).alias("c"), F.lit(191).alias("a")),
                *[F.struct(F.lit(c).alias("c"), F.lit(a).alias("a"))
                  for c, a in ((300, 30), (301, 31), (302, 30), (302, 32))],
            ),
            F.when(nation < 3, F.array(F.struct(F.lit(0).alias("c"), (10 + nation).alias("a")))).otherwise(F.array()),
        )
        return (
            self.table("nation").select(F.inline(pairs).alias("c", "a")).distinct()
            .select(F.col("c").cast("bigint").alias("ClassID"), F.col("a").cast("bigint").alias("AttributeID"))
        )

    @cached_property
    def class_kinds(self) -> DataFrame:
        """Kinds of the attributes in the class mapping."""
        nation = F.col("n_nationkey")
        own = F.when(~(10 + nation).isin(30, 31, 32), F.array(F.struct((10 + nation).alias("i"), (nation % 4).alias("t"))))
        common = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("t")) for i, t in ((30, 2), (31, 2), (32, 2), (191, 3))])
        return (
            self.table("nation").select(F.inline(F.concat(F.coalesce(own, F.array()), common)).alias("i", "t")).distinct()
            .select(F.col("i").cast("bigint").alias("ID"), F.col("t").cast("int").alias("_TypeID"))
        )

    @cached_property
    def customer_items(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("ID"), F.lit(2).cast("bigint").alias("LanguageID"), F.col("c_name").alias("Label"),
            F.col("c_mktsegment").alias("Segment"), F.format_string(" %d ", 400 + key % 3).alias("ClassMapping"),
            (key + 5).alias("_ExtensionID"),
        )

    @cached_property
    def deleted(self) -> DataFrame:
        """Deleted workflows and states, read from delete messages (id, item type, field, value)."""
        from tidemark.sources.changes import read_delete

        ident = F.col("ID")
        kind = F.when(ident % 2 == 0, "Pdmarticle").otherwise("Mamfile")
        message = F.when(
            ident % 9 == 0, F.format_string("%d, %s, WorkflowID, %d", ident, kind, ident % 4)
        ).otherwise(F.format_string("%d, %s, StateID, %d", ident, kind, ident % 60))
        read = self.changes.where(F.col("Action") == 2).select(read_delete("ID", message).alias("d"))
        return read.select("d.item_type", "d.field", "d.value").distinct()

    @cached_property
    def headers(self) -> DataFrame:
        """Header dictionary rows, one per supplier as an item type."""
        key = F.col("s_suppkey")
        data = F.concat(
            F.lit('{"StandardFields":{"ID":"bigint","Label":"text","LastChange":"timestamp","Hits":"","Classes":"list<int>"},'),
            F.lit('"CustomFields":{"'), text(key), F.lit(':Value":"'),
            F.when(key % 2 == 0, "html").otherwise("text"),
            F.lit('","n'), text("s_nationkey"), F.lit(':Value":"html"},'),
            F.lit('"SearchableFields":{"Label":"text","'), text(key), F.lit(':Value":"html"},'),
            F.lit('"SearchableReferences":["30","'), text("s_nationkey"), F.lit('"],'),
            F.lit('"SearchableSubtables":["191"],"LanguageIds":"1,2,3"}'),
        )
        return self.table("supplier").select(
            F.col("s_name").alias("ItemType"),
            F.when(key % 4 == 3, "Configuration").otherwise("item").alias("Type"),
            data.alias("Data"),
        )
