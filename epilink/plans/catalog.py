"""Every operator as a query over the test tables, keyed by name.

The tables are read through ``Tables``, which gives them the columns of the
harmonised sources: orders stand for case reports and urgent ones for alerts,
line items for weather readings, parts for policies, documents for news.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .. import schemas, vocabulary
from ..functions import numeric, records, temporal, text
from ..operators import aggregates, geo, graph, link, metrics, names, patterns, topn, triples
from ..session import scratch_path
from ..sinks import (
    append_metrics,
    merge_graph,
    read_dictionary,
    update_dictionary,
    write_json_map,
    predicate_tags,
    predicates_of,
    rdfxml_rows,
    to_messages,
    turtle_blocks,
    upsert_by_key,
    write_batch,
    write_graph,
    write_ntriples,
    write_table,
    write_triples,
)
from ..sources import (
    explode_json_map,
    flatten_weather,
    parse_feed_items,
    parse_json,
    parse_ntriples,
    quarantine_json,
    read_metrics,
    read_ntriples,
    read_optional,
    read_statistics,
    read_table,
    read_triples,
    rejected_feeds,
    rejected_ntriples,
    stream_table,
    read_batches,
    read_json_map,
    read_graph,
    read_log,
    union_all,
)
from ..streaming import SourceConfig, harmonize, harmonize_stream, run_all
from . import ingest

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

# Spellings of places, one per customer in turn; the last stands for the customer's own name.
SPELLINGS = [
    "D.G Khan",
    "dg-khan",
    "R. Y  Khan",
    "RAHIMYARKHAN",
    "Lahore City",
    "pindi",
    "m.b_din",
    "isb,",
    "",
    None,
    "unknown o'place",
    "...",
]


class Tables:
    """The test tables under the names and columns of the harmonised sources."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    # Schemas by path: a footer is read once, not for every use of a table.
    _schemas: dict[str, StructType] = {}

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = read_table(self.spark, path).schema
        return read_table(self.spark, path, schema=self._schemas[path])

    def _placed_orders(self) -> DataFrame:
        return self.orders.join(self.customer, F.col("o_custkey") == F.col("c_custkey")).withColumns(
            {
                "district_canonical": F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")),
                "epi_week_key": temporal.week_key(F.col("o_orderdate")),
            }
        )

    def cases(self) -> DataFrame:
        return self._placed_orders().select(
            F.col("o_orderkey").alias("record_id"),
            "district_canonical",
            "epi_week_key",
            F.col("o_orderstatus").alias("disease"),
            numeric.clamp_to_zero(F.col("o_totalprice")).alias("case_count"),
        )

    def weather(self) -> DataFrame:
        joined = self.lineitem.join(self.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        return joined.select(
            F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")).alias("district_canonical"),
            temporal.week_key(F.col("l_shipdate")).alias("epi_week_key"),
            F.col("l_quantity").alias("temperature_c"),
            F.col("l_extendedprice").alias("humidity_pct"),
            F.col("l_discount").alias("precipitation_mm"),
            F.col("l_tax").alias("wind_speed_kmh"),
        )

    def alerts(self) -> DataFrame:
        """Some alerts have no id or no severity, as in real feeds."""
        return self._placed_orders().where(F.col("o_orderpriority") == "1-URGENT").select(
            "district_canonical",
            "epi_week_key",
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("alert_id"),
            F.col("o_orderstatus").alias("event_type"),
            F.nullif("c_mktsegment", F.lit("BUILDING")).alias("severity"),
        )

    def policy(self) -> DataFrame:
        return self.part.select(
            F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("title"),
            F.col("p_brand").alias("status"),
        )

    def graph(self) -> DataFrame:
        return triples.knowledge_graph(self.cases(), self.weather(), self.alerts(), self.policy())

    def stored_graph(self) -> DataFrame:
        """The graph computed once and stored by predicate, as the graph tables read it in practice.

        Over a graph still to be computed Spark would drop its merging of triples in
        favour of the later, coarser grouping and carry every repeat up to there.
        """
        return read_triples(self.spark, write_triples(self.graph(), scratch_path(self.spark, "triples")))

    def spelled_customers(self) -> DataFrame:
        spellings = F.array(*[F.lit(s).cast("string") for s in SPELLINGS], F.concat(F.lit("tehsil "), "c_name"))
        turn = F.pmod(F.col("c_custkey"), F.lit(len(SPELLINGS) + 1)).cast("int")
        return self.customer.select("c_custkey", F.get(spellings, turn).alias("raw"))

    def spelled_parts(self) -> DataFrame:
        turn = F.pmod(F.col("p_partkey"), F.lit(4))
        sep = F.when(turn == 0, " ").when(turn == 1, ".").when(turn == 2, "-").otherwise("  ")
        first, second = F.substring_index("p_name", " ", 1), F.substring_index("p_name", " ", -1)
        return self.part.select("p_partkey", F.concat(F.lit(" "), F.upper(first), sep, second).alias("raw"))


def _rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Means are compared to six digits, as the order of summation is not fixed."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def _stream_table(spark, folder, name, kind, schema, table, file_name, project) -> DataFrame:
    """Run a source from a Parquet table, a file or a folder, as messages to its harmonised table."""
    files = stream_table(spark, folder, read_table(spark, folder, file_name).schema, file_name)
    config = SourceConfig(
        name=f"{name}",
        topic=name,
        schema=schema,
        kind=kind,
        path=scratch_path(spark, table),
        checkpoint=scratch_path(spark, f"{table}-checkpoint"),
    )
    (query,) = harmonize_stream(
        spark, config, available_now=True, messages=to_messages(files.select(*project))
    )
    query.awaitTermination()
    return read_table(spark, config.path).drop("processed_at")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a function of the tables under its own name, without the suffix ``_query``."""
    QUERIES[fn.__name__.removesuffix("_query")] = lambda spark, folder: fn(Tables(spark, folder))
    return fn


# Link ---------------------------------------------------------------------------------

MEANS = list(link.WEATHER_MEANS)


@query
def link_sources(t: Tables) -> DataFrame:
    return _rounded(link.link_sources(t.cases(), t.weather(), t.alerts()), *MEANS)


@query
def link_ranked(t: Tables) -> DataFrame:
    linked = link.link_sources(t.cases(), t.weather(), t.alerts(), severity="rank", scale=SEGMENTS)
    return linked.select("record_id", "disaster_event_count", "max_severity", "has_concurrent_disaster")


@query
def link_no_alerts(t: Tables) -> DataFrame:
    none = read_optional(t.spark, t.folder, "no_such_table", schemas.harmonised("alerts"))
    return _rounded(link.link_sources(t.cases(), t.weather(), none), *MEANS)


@query
def weekly_means(t: Tables) -> DataFrame:
    return _rounded(link.weekly_means(t.weather()), *MEANS)


@query
def weekly_alerts(t: Tables) -> DataFrame:
    return link.weekly_alerts(t.alerts())


@query
def linked_sample(t: Tables) -> DataFrame:
    linked = link.link_sources(t.cases(), t.weather(), t.alerts())
    return _rounded(topn.linked_sample(linked, 10), "avg_temperature_c", "avg_precipitation_mm")


# Time ---------------------------------------------------------------------------------


def _weeks(df: DataFrame, rule: str) -> DataFrame:
    day = F.col("o_orderdate")
    return df.select(
        "o_orderkey",
        temporal.epi_year(day, rule).alias("epi_year"),
        temporal.epi_week(day, rule).alias("epi_week"),
        temporal.week_key(day, rule).alias("epi_week_key"),
    )


@query
def epi_week(t: Tables) -> DataFrame:
    return _weeks(t.orders, "thursday")


@query
def epi_week_mmwr(t: Tables) -> DataFrame:
    return _weeks(t.orders, "mmwr")


@query
def epi_week_from_text(t: Tables) -> DataFrame:
    form = F.pmod("o_orderkey", F.lit(5))
    written = (
        F.when(form == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(form == 1, F.date_format("o_orderdate", "yyyy-MM-dd'T23:30:00+05:00'"))
        .when(form == 2, F.date_format("o_orderdate", "yyyy-MM-dd'T01:00:00Z'"))
        .when(form == 3, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T25:00:00'"))
    )
    return t.orders.select(
        "o_orderkey", temporal.week_key(temporal.iso_text_to_date(written)).alias("epi_week_key")
    )


@query
def split_week_key(t: Tables) -> DataFrame:
    return temporal.split_week_key(t.orders.select("o_orderkey", temporal.week_key(F.col("o_orderdate")).alias("epi_week_key")))


@query
def month_key(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.month(day).alias("report_month"),
        F.year(day).alias("report_year"),
        temporal.month_label(day).alias("report_month_label"),
    )


@query
def extract_temporal_key(t: Tables) -> DataFrame:
    """Alert sentences with the date written in different ways; some hold none."""
    day, form = F.col("o_orderdate"), F.pmod("o_orderkey", F.lit(6))
    sentence = temporal.alert_sentence(F.col("o_orderpriority"), F.col("o_orderstatus"), day, F.lit("severe"))
    written = (
        F.when(form == 0, sentence)
        .when(form == 1, F.concat(F.lit("Update of "), F.date_format(day, "yyyy-MM-dd"), F.lit(". "), sentence))
        .when(form == 2, F.date_format(day, "'On' MMMM d, yyyy 'water rose.'"))
        .when(form == 3, F.concat(F.lit("Week "), temporal.week_key(day), F.lit(" closed.")))
        .when(form == 4, F.concat(F.lit("Not 2024-02-31 but "), F.date_format(day, "d MMM yyyy")))
        .otherwise(F.lit("Rain since last week."))
    )
    return t.orders.select("o_orderkey", temporal.extract_temporal_key(written, F.lit("2000-W01")).alias("temporal_key"))


# Phrases that name a day or week by the day of the report, one per order in turn.
PHRASES = [
    "Flooding began yesterday near the town.",
    "Rain since last week.",
    "Two days ago the river rose",
    "It ended on Monday, not earlier.",
    "Last   Thursday it broke.",
    "Crews arrive next Sunday",
    "Reported 3 weeks ago by the office",
    "Nothing is known.",
    "On 2024-02-31, that is today, it closed.",
]


@query
def extract_relative_key(t: Tables) -> DataFrame:
    """Report texts with relative phrases, and a date that comes first in some."""
    day = F.col("o_orderdate").cast("date")
    said = F.get(F.array(*map(F.lit, PHRASES)), F.pmod("o_orderkey", F.lit(len(PHRASES))).cast("int"))
    written = F.when(F.pmod("o_orderkey", F.lit(50)) == 7, F.concat(F.lit("As of 5 March 1997: "), said)).otherwise(said)
    return t.orders.select("o_orderkey", temporal.extract_relative_key(written, day, F.lit("none")).alias("temporal_key"))


@query
def alert_sentences(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        temporal.alert_sentence(
            F.lower("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate"), F.lit("minor")
        ).alias("description"),
    )


# Messages and payloads ----------------------------------------------------------------


def _event_messages(t: Tables) -> DataFrame:
    """Events as JSON; every tenth is cut short, others lack a field or hold a wrong type."""
    form = F.pmod("event_id", F.lit(10))
    whole = F.to_json(F.struct("event_id", "event_type", "value", "props", F.lit("x").alias("extra")))
    return t.events.select(
        F.when(form == 0, F.left(whole, F.length(whole) - 5))
        .when(form == 1, F.to_json(F.struct("event_id", "event_type")))
        .when(form == 2, F.to_json(F.struct("event_id", F.lit("much").alias("value"))))
        .otherwise(whole)
        .alias("value")
    )


EVENT_MESSAGE = schemas.fields(event_id=schemas.L, event_type=schemas.S, value=schemas.D, props=schemas.S)


@query
def parse_events(t: Tables) -> DataFrame:
    rows = parse_json(_event_messages(t), EVENT_MESSAGE).where(F.col("event_id").isNotNull())
    k = F.from_json("props", "k INT")["k"].alias("k")
    return records.with_defaults(rows.select("event_id", "event_type", "value", k), {"event_type": "none", "k": -1})


@query
def quarantine(t: Tables) -> DataFrame:
    """What stays of messages that cannot be parsed: a row of nulls, or the part before the fault."""
    good, bad = quarantine_json(_event_messages(t), EVENT_MESSAGE)
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
        for kind, df in (("good", good), ("bad", bad))
    ]
    return union_all(counted)


@query
def flatten_weather_query(t: Tables) -> DataFrame:
    reading = F.to_json(
        F.struct(
            F.struct(
                F.col("l_quantity").alias("temperature_2m"),
                F.col("l_extendedprice").alias("relative_humidity_2m"),
                F.col("l_tax").alias("wind_speed_10m"),
                F.when(F.col("l_linenumber") > 1, F.col("l_discount")).alias("precipitation"),
            ).alias("current"),
            F.lit(31.5).alias("latitude"),
        )
    )
    return flatten_weather(t.lineitem.select("l_orderkey", "l_linenumber", reading.alias("value")))


@query
def to_messages_query(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return parse_json(to_messages(rows), rows.schema)


@query
def json_map(t: Tables) -> DataFrame:
    """Customers' own small gazetteers, one JSON object each, as rows."""
    coordinates = F.struct((F.col("c_nationkey") + F.lit(0.5)).alias("lat"), F.col("c_acctbal").alias("lon"))
    entry = F.create_map(text.gazetteer_key(F.col("c_name"), F.lit("Pakistan")), coordinates, F.lit("home"), coordinates)
    return explode_json_map(t.customer.select("c_custkey", F.to_json(entry).alias("j")), "j").select(
        "c_custkey", "key", "lat", "lon"
    )


@query
def json_map_round_trip(t: Tables) -> DataFrame:
    """A gazetteer of all customers stored, updated for every third with a later entry that wins, exported as one object and read."""
    place = text.gazetteer_key(F.col("c_name"), F.lit("Pakistan"))
    named = t.customer.select(place.alias("key"), (F.col("c_nationkey") + F.lit(0.5)).alias("lat"), F.col("c_acctbal").alias("lon"), "c_custkey")
    store = scratch_path(t.spark, "gazetteer")
    update_dictionary(named.drop("c_custkey"), store)
    moved = named.where("c_custkey % 3 = 0").withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("lat", F.col("lat") + 100 * F.col("seq"))
    update_dictionary(moved.drop("c_custkey"), store, order_by="seq")
    return read_json_map(t.spark, write_json_map(read_dictionary(t.spark, store), scratch_path(t.spark, "gazetteer-json"))).select("key", "lat", "lon")


def _feeds(t: Tables) -> DataFrame:
    """Each document as a feed of seven items; some miss their date or their link."""
    title = lambda n: F.concat(F.col("lang"), F.lit(f" {n} & <more>"))
    items = F.array(
        F.struct(F.col("text").alias("title"), F.lit("http://example.org/0").alias("link"), F.lit("Tue, 30 Jun 2026").alias("pubDate")),
        *[
            F.struct(
                title(n).alias("title"),
                F.when(F.lit(n % 2 == 0), F.concat(F.lit("http://example.org/"), F.col("doc_id"))).alias("link"),
                F.lit(None).cast("string").alias("pubDate"),
            )
            for n in range(1, 7)
        ],
    )
    feed = F.to_xml(F.struct(F.struct(items.alias("item")).alias("channel")), {"rowTag": "rss"})
    return t.documents.select("doc_id", "source", feed.alias("feed"))


@query
def feed_items(t: Tables) -> DataFrame:
    return parse_feed_items(_feeds(t), "feed").select("doc_id", "source", "position", "title", "link", "published")


@query
def feed_rejected(t: Tables) -> DataFrame:
    """Feeds of which some are cut within their third item, no XML, no feed, blank, or RSS 1.0; items read and why not all."""
    form, feed = F.pmod("doc_id", F.lit(7)), F.col("feed")
    first = F.concat(F.lit('<item rdf:about="a">'), F.substring_index(F.substring_index(feed, "<item>", -7), "</item>", 1), F.lit("</item>"))
    written = (
        F.when(form == 1, F.concat(F.substring_index(feed, "</item>", 2), F.lit("</item><item><title>cu")))
        .when(form == 2, F.lit("no feed today & nothing else"))
        .when(form == 3, F.lit("<html><body>moved</body></html>"))
        .when(form == 4, F.concat(F.lit('<rdf:RDF xmlns:rdf="r" xmlns="n"><channel rdf:about="u"><title>c</title></channel>'), first, F.lit("</rdf:RDF>")))
        .when(form == 5, F.lit(" "))
        .when(form == 6, F.lit("<rss><channel></channel></rss>"))
        .otherwise(feed)
    )
    feeds = _feeds(t).withColumn("feed", written)
    read = parse_feed_items(feeds, "feed").groupBy("doc_id").agg(F.count(F.lit(1)).alias("items"))
    rejected = rejected_feeds(feeds, "feed").select("doc_id", "reason", "saved")
    return read.join(rejected, "doc_id", "full").select("doc_id", F.coalesce("items", F.lit(0)).alias("items"), "reason", "saved")


@query
def news_items(t: Tables) -> DataFrame:
    return ingest.news_records(_feeds(t), "feed").select("source", "title", "link", "published")


@query
def top_n_per_source(t: Tables) -> DataFrame:
    return topn.top_n_per(t.documents.select("source", "doc_id", "text"), ["source"], ["doc_id"], vocabulary.ITEMS_PER_FEED)


# Names and places ---------------------------------------------------------------------


@query
def normalize_name(t: Tables) -> DataFrame:
    norm = text.normalize_name(F.col("raw"))
    return t.spelled_parts().select("p_partkey", norm.alias("norm"), text.squeeze(norm).alias("tight"))


@query
def title_name(t: Tables) -> DataFrame:
    return t.spelled_parts().select("p_partkey", text.python_title(text.python_strip(F.col("raw"))).alias("title"))


@query
def resolve_names(t: Tables) -> DataFrame:
    return names.resolve_names(t.spelled_customers(), "raw")


@query
def resolve_names_by_joins(t: Tables) -> DataFrame:
    """Dictionary made of the parts."""
    aliases = t.part.groupBy(F.col("p_name").alias("alias")).agg(
        F.min("p_partkey").alias("rank"), F.min("p_brand").alias("province")
    ).withColumn("canonical", F.upper("alias"))
    form = F.pmod("p_partkey", F.lit(5))
    raw = (
        F.when(form == 0, F.upper("p_name"))
        .when(form == 1, F.replace("p_name", F.lit(" "), F.lit("")))
        .when(form == 2, F.concat(F.lit("the "), "p_name", F.lit(" set"), F.col("p_partkey")))
        .when(form == 3, F.substring_index("p_name", " ", 1))
        .otherwise(F.concat(F.lit("zz"), F.col("p_partkey")))
    )
    return names.resolve_names(t.part.select("p_partkey", raw.alias("raw")), "raw", aliases)


@query
def geocode(t: Tables) -> DataFrame:
    """Nations up to 14 are in the gazetteer, 10 to 19 in the fallback list, others in neither."""
    nation = t.nation.select("n_name", "n_nationkey", (F.col("n_nationkey") * F.lit(1.5)).alias("lat"), F.lit(70.25).alias("lon"))
    gazetteer = nation.where(F.col("n_nationkey") < 15).select(
        text.gazetteer_key(F.col("n_name"), F.lit("Pakistan")).alias("key"), "lat", "lon"
    )
    fallback = nation.where(F.col("n_nationkey").between(10, 19)).select(
        F.col("n_name").alias("name"), (F.col("lat") + 100).alias("lat"), "lon"
    )
    named = t.customer.select("c_custkey", F.concat(F.lit(" Nation_"), F.col("c_nationkey")).alias("place"))
    return geo.geocode(named, "place", gazetteer, fallback)


@query
def geocode_duplicates(t: Tables) -> DataFrame:
    """Dictionaries with an entry per customer, so that every place comes many times."""
    at = t.customer.select("c_nationkey", F.col("c_acctbal").alias("lat"), F.col("c_custkey").cast("double").alias("lon"))
    place = F.concat(F.lit("Nation_"), F.col("c_nationkey"))
    gazetteer = at.where("c_nationkey < 15").select(text.gazetteer_key(place, F.lit("Pakistan")).alias("key"), "lat", "lon")
    spelled = F.when(F.col("lon") % 2 == 0, F.upper(place)).otherwise(place)
    fallback = at.where("c_nationkey BETWEEN 10 AND 19").select(spelled.alias("name"), "lat", "lon")
    return geo.geocode(t.customer.select("c_custkey", place.alias("place")), "place", gazetteer, fallback)


@query
def upsert_by_key_query(t: Tables) -> DataFrame:
    """Supplier balances replaced by their latest return."""
    old = t.supplier.select("s_suppkey", F.col("s_acctbal").alias("amount"), F.lit(0).cast("long").alias("seq"))
    new = t.lineitem.where(F.col("l_returnflag") == "R").select(
        F.col("l_suppkey").alias("s_suppkey"),
        F.col("l_extendedprice").alias("amount"),
        (F.col("l_orderkey") * 1_000_000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )
    return upsert_by_key(old, new, "s_suppkey", "seq")



@query
def surveillance_records(t: Tables) -> DataFrame:
    """Order rows with raw place names to complete surveillance messages and back."""
    raw = t.orders.join(t.spelled_customers(), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("raw").alias("district"),
        F.col("o_orderstatus").alias("disease"),
        F.col("o_totalprice").cast("int").alias("case_count"),
        F.col("o_orderkey").cast("double").alias("idsr_compliance_pct"),
        "o_orderdate",
    )
    sent = to_messages(ingest.surveillance_records(raw, F.col("o_orderdate")))
    rows = temporal.with_epi_week_key(parse_json(sent, schemas.SURVEILLANCE))
    return rows.select(
        F.col("idsr_compliance_pct").cast("long").alias("o_orderkey"),
        "source",
        "district",
        "district_canonical",
        "province",
        "lat",
        "lon",
        "disease",
        "case_count",
        "epi_week_key",
    )


@query
def alert_records(t: Tables) -> DataFrame:
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("district"),
        F.lower("o_orderstatus").alias("event_type"),
        F.col("o_orderpriority").alias("severity"),
        "o_orderdate",
    )
    rows = ingest.alert_records(raw, F.col("o_orderdate"))
    return rows.select(
        F.col("district").cast("long").alias("o_orderkey"),
        "description",
        "extracted_temporal_key",
        "epi_year",
        "epi_week",
        "issued_at",
        F.length("alert_id").alias("id_length"),
    )


# Summaries and metrics ----------------------------------------------------------------


@query
def total_by(t: Tables) -> DataFrame:
    return aggregates.total_by(t.cases(), "district_canonical", "case_count", "cases")


@query
def mean_by(t: Tables) -> DataFrame:
    return _rounded(aggregates.mean_by(t.weather(), "district_canonical", "temperature_c", "temp"), "temp")


@query
def count_by(t: Tables) -> DataFrame:
    return aggregates.count_by(t.alerts(), "district_canonical", "alerts")


def _event_metrics(t: Tables) -> DataFrame:
    return metrics.ingestion_metrics(
        t.events.withColumn("day", F.col("ts").cast("date")),
        F.col("value") > 5,
        "event_type",
        by=["day"],
        error=F.lit("value too small"),
    )


@query
def ingestion_metrics(t: Tables) -> DataFrame:
    return _event_metrics(t).drop("timestamp").withColumn("errors", F.array_join("errors", "; "))


@query
def summarize_metrics(t: Tables) -> DataFrame:
    """The run log is written and read back before it is summed up."""
    log = append_metrics(_event_metrics(t).drop("day"), scratch_path(t.spark, "metrics"))
    return metrics.summarize_metrics(read_metrics(t.spark, log))


# Streams and tables -------------------------------------------------------------------


@query
def harmonize_week(t: Tables) -> DataFrame:
    day = F.col("ts")
    return _stream_table(
        t.spark, t.folder, "surveillance", "week", schemas.SURVEILLANCE, "weekly", "events.parquet",
        [
            F.col("event_id").cast("string").alias("record_id"),
            F.lit("events").alias("source"),
            temporal.epi_year(day).alias("epi_year"),
            temporal.epi_week(day).alias("epi_week"),
            F.col("event_type").alias("district"),
            F.col("props").alias("disease"),
            F.col("user_id").alias("case_count"),
            F.col("value").alias("idsr_compliance_pct"),
        ],
    ).select("record_id", "source", "district", "district_canonical", "disease", "case_count", "idsr_compliance_pct", "epi_week_key")


def _event_messages_by_week(t: Tables) -> DataFrame:
    day = F.col("ts")
    rows = t.events.select(
        F.col("event_id").cast("string").alias("record_id"),
        F.lit("events").alias("source"),
        temporal.epi_year(day).alias("epi_year"),
        temporal.epi_week(day).alias("epi_week"),
        F.col("event_type").alias("district"),
        F.col("user_id").alias("case_count"),
    )
    return to_messages(rows)


def _batch_source(t: Tables, label: str) -> SourceConfig:
    """A weekly source of text files, one file a batch."""
    return SourceConfig(
        name=label,
        topic=scratch_path(t.spark, f"{label}-topic"),
        schema=schemas.SURVEILLANCE,
        kind="week",
        path=scratch_path(t.spark, label),
        checkpoint=scratch_path(t.spark, f"{label}-checkpoint"),
        format="text",
        options={"maxFilesPerTrigger": "1"},
        sink="batches",
    )


_HARMONISED = ["record_id", "source", "district", "case_count", "epi_week_key"]


@query
def harmonize_compacted(t: Tables) -> DataFrame:
    """Events in ten batches of a table with a log, merged on the way, after which two batches are written once more."""
    source = _batch_source(t, "compacted")
    messages = _event_messages_by_week(t)
    messages.repartition(10).write.text(source.topic)
    run_all(t.spark, [source], available_now=True)
    replayed = harmonize(messages.limit(100), source.schema, source.kind)
    for batch_id in (9, 3):
        write_batch(replayed, batch_id, source.path, "epi_week_key")
    return read_batches(t.spark, source.path).select(*_HARMONISED)


@query
def harmonize_restart(t: Tables) -> DataFrame:
    """Events of which the second half arrives after the stream has ended; rows and logged rows by week."""
    source = _batch_source(t, "restarted")
    messages = _event_messages_by_week(t)
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    for part in (0, 1):
        messages.where(half == part).repartition(2).write.mode("append").text(source.topic)
        run_all(t.spark, [source], available_now=True)
    logged = metrics.batch_metrics(read_log(t.spark, source.path), source.name).agg(F.sum("records_succeeded")).first()[0]
    rows = read_batches(t.spark, source.path).groupBy("epi_week_key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("record_id").alias("records"))
    return rows.withColumn("logged", F.lit(logged).cast("long"))


@query
def harmonize_month(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    rows = _stream_table(
        t.spark, t.folder, "policy", "month", schemas.POLICY, "monthly", "orders.parquet",
        [
            F.col("o_orderkey").cast("string").alias("record_id"),
            F.col("o_orderpriority").alias("title"),
            F.array("o_orderstatus", "o_orderpriority").alias("sectors"),
            F.month(day).alias("report_month"),
            F.year(day).alias("report_year"),
            temporal.month_label(day).alias("report_month_label"),
        ],
    )
    return rows.select("record_id", "title", "report_month", "report_month_label", F.explode("sectors").alias("sector"))


@query
def harmonize_plain(t: Tables) -> DataFrame:
    return _stream_table(
        t.spark, t.folder, "news", "plain", schemas.NEWS, "news", "documents.parquet",
        ["source", F.col("text").alias("title"), F.col("doc_id").cast("string").alias("link"), F.lit("").alias("published")],
    )


@query
def write_table_query(t: Tables) -> DataFrame:
    """Monthly partitions written, then read as one table of files without the partition column."""
    rows = t.orders.withColumn("report_month_label", temporal.month_label(F.col("o_orderdate")))
    path = write_table(rows, scratch_path(t.spark, "orders"), "report_month_label")
    return read_table(t.spark, path, recursive=True, schema=rows.drop("report_month_label").schema)


@query
def with_record_id(t: Tables) -> DataFrame:
    cols = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    return records.with_source(t.orders, "orders").select(
        "source",
        "o_orderkey",
        records.record_id(cols).alias("record_id"),
        records.prefixed_id(cols, vocabulary.ALERT_ID_PREFIX).alias("alert_id"),
    )


# Graph --------------------------------------------------------------------------------


@query
def triples_query(t: Tables) -> DataFrame:
    return t.graph()


@query
def triple_count(t: Tables) -> DataFrame:
    return t.graph().agg(F.count(F.lit(1)).alias("triples"))


@query
def policy_status(t: Tables) -> DataFrame:
    return patterns.policy_status(triples.triples_from(t.policy(), triples.policy_statements()))


@query
def bgp(t: Tables) -> DataFrame:
    """Places that share a disease and a disaster with their classes."""
    ns = vocabulary.NAMESPACE
    return patterns.bgp(
        t.stored_graph(),
        [
            ("?place", ns + "hasDisease", "?disease"),
            ("?disease", vocabulary.RDF_TYPE, ns + "Disease"),
            ("?place", ns + "hasDisaster", "?disaster"),
        ],
    )


@query
def bgp_reordered(t: Tables) -> DataFrame:
    """The patterns of ``bgp`` from the largest to the smallest, over a stored graph with statistics."""
    ns, path = vocabulary.NAMESPACE, scratch_path(t.spark, "graph-store")
    merge_graph(t.graph(), path)
    return patterns.bgp(
        read_graph(t.spark, path),
        [
            ("?place", ns + "hasDisease", "?disease"),
            ("?place", ns + "hasDisaster", "?disaster"),
            ("?disease", vocabulary.RDF_TYPE, ns + "Disease"),
        ],
        statistics=read_statistics(t.spark, path),
    )


@query
def triples_merged(t: Tables) -> DataFrame:
    """The graph stored in two merges, one for each half of the cases and alerts; the second also brings all the rest again."""
    path = scratch_path(t.spark, "graph-store")
    half = lambda df, n: df.where(F.pmod(F.xxhash64("district_canonical", "epi_week_key"), F.lit(2)) == n)
    for n in (0, 1):
        merge_graph(triples.knowledge_graph(half(t.cases(), n), t.weather(), half(t.alerts(), n), t.policy()), path)
    return read_graph(t.spark, path)


@query
def ntriples_round_trip(t: Tables) -> DataFrame:
    return read_ntriples(t.spark, write_ntriples(t.graph(), scratch_path(t.spark, "graph")))


@query
def ntriples_text(t: Tables) -> DataFrame:
    """Whole documents as literals, escaped to one line each."""
    named = t.documents.select(F.col("doc_id").cast("string").alias("title"), F.col("text").alias("status"))
    made = triples.triples_from(named, triples.policy_statements())
    return read_ntriples(t.spark, write_ntriples(made, scratch_path(t.spark, "texts")))


# Characters that lines, IRIs or literals cannot hold as they are, one kind per document in turn.
AWKWARD = ["\u0085", "\u2028", "\f", ">", '"', "\\", "\n\t\v", "\\\n\u0001"]


@query
def ntriples_hard_text(t: Tables) -> DataFrame:
    """Whole documents with awkward characters before and after them, and in the subject."""
    awkward = F.get(F.array(*map(F.lit, AWKWARD)), F.pmod("doc_id", F.lit(len(AWKWARD))).cast("int"))
    named = t.documents.select(
        F.concat(F.col("doc_id").cast("string"), awkward, F.lit("x")).alias("title"), F.concat(awkward, "text", awkward).alias("status")
    )
    made = triples.triples_from(named, triples.policy_statements())
    return read_ntriples(t.spark, write_ntriples(made, scratch_path(t.spark, "hard-texts")))


@query
def ntriples_rejected(t: Tables) -> DataFrame:
    """Lines of other writers: what is read from them, and those that are no statement."""
    form, start = F.pmod("doc_id", F.lit(6)), F.concat(F.lit("<http://x/"), "doc_id", F.lit("> <http://x/p> "))
    line = (
        F.when(form == 0, F.concat(start, F.lit('"no end .')))
        .when(form == 1, F.concat(F.lit("# "), "doc_id"))
        .when(form == 2, F.concat(start, F.lit('"\\q" .')))
        .when(form == 3, F.concat(start, F.lit('"\\U0001F600\\u00e9\\"" . # a "comment"')))
        .when(form == 4, F.concat(F.lit("_:b"), "doc_id", F.lit(" <http://x/p> _:c.")))
        .otherwise(F.concat(start, F.lit("<http://x/\\u003E>.")))
    )
    lines = t.documents.select(line.alias("value"))
    read = parse_ntriples(lines).select("s", "o", F.lit("read").alias("kind"))
    return read.unionByName(rejected_ntriples(lines).select(F.lit("").alias("s"), F.col("line").alias("o"), F.lit("rejected").alias("kind")))


@query
def bgp_literal(t: Tables) -> DataFrame:
    """Places with a temperature of 25.0 as a double; their twins hold the same text without a type."""
    made = triples.triples_from(t.weather(), triples.weather_statements())
    twins = made.withColumns({"s": F.concat("s", F.lit("/twin")), "o_datatype": F.lit(None).cast("string")})
    name = vocabulary.NAMESPACE + "temperature"
    return patterns.bgp(made.unionByName(twins), [("?place", name, f'"25.0"^^<{vocabulary.XSD_DOUBLE}>')])


@query
def turtle_blocks_query(t: Tables) -> DataFrame:
    return turtle_blocks(t.graph()).select("s", "value")


@query
def rdfxml_rows_query(t: Tables) -> DataFrame:
    """Every statement of the table that is written as RDF/XML."""
    stored = t.stored_graph()
    tags, _ = predicate_tags(predicates_of(stored), vocabulary.NAMESPACE)
    objects = F.array(*[F.struct(F.lit(tag).alias("tag"), F.col(f"`{tag}`").alias("object")) for tag in tags.values()])
    flat = rdfxml_rows(stored, tags).select(F.col("`_rdf:about`").alias("s"), F.inline(objects)).where(F.col("object").isNotNull())
    return flat.select("s", "tag", *[F.col(f"object.`{c}`").alias(n) for c, n in (("_rdf:resource", "resource"), ("_rdf:datatype", "datatype"), ("_VALUE", "value"))])


@query
def property_nodes(t: Tables) -> DataFrame:
    return graph.property_nodes(t.stored_graph())


@query
def property_edges(t: Tables) -> DataFrame:
    return graph.property_edges(t.stored_graph())


@query
def property_graph_round_trip(t: Tables) -> DataFrame:
    """Degree of every node of the property graph as stored."""
    nodes, edges = write_graph(*graph.property_graph(t.stored_graph()), scratch_path(t.spark, "property-graph"))
    ends = read_table(t.spark, edges).select(
        F.inline(
            F.array(
                F.struct(F.col("src_label").alias("label"), F.col("src").alias("name")),
                F.struct(F.col("dst_label").alias("label"), F.col("dst").alias("name")),
            )
        )
    )
    degrees = ends.groupBy("label", "name").agg(F.count(F.lit(1)).alias("degree"))
    joined = read_table(t.spark, nodes).join(degrees, ["label", "name"], "left")
    return records.with_defaults(joined, {"degree": 0})


@query
def edge_table(t: Tables) -> DataFrame:
    return graph.edge_table(t.stored_graph())


@query
def graph_nodes(t: Tables) -> DataFrame:
    return graph.graph_nodes(graph.edge_table(t.stored_graph()))
