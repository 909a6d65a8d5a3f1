"""Decoding, validation, text and scalar functions over the driver's tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.functions import scalars as C
from kerbside.functions import text as X
from kerbside.learning.features import prob_of
from kerbside.operators import decode as D
from kerbside.operators import tweets as W
from kerbside.operators import validate as V
from kerbside.plans.catalog import query
from kerbside.plans.oracle_views import half_up

EV = ("ev",)


@query(
    "src_kafka_meta",
    "SELECT 'user-' || user_id AS key, props AS message, 'events' AS topic, user_id % 3 AS partition, "
    "event_id AS offset, et AS timestamp FROM ev",
    EV,
)
def _(t):
    return D.kafka_metadata(t.messages).drop("processing_time")


@query("src_parquet", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def _(t):
    orders = t.table("orders").filter(F.col("o_totalprice") > 250000)
    return C.project(orders, "o_orderkey", "o_custkey", "o_totalprice")


@query(
    "src_views",
    "SELECT TaxiType, count(*) AS drivers, round(avg(Rating), 6) AS rating FROM all_taxis JOIN drivers "
    "ON TaxiID = TaxiIDDriving GROUP BY TaxiType",
    ("all_taxis", "drivers"),
)
def _(t):
    from kerbside.sources.dimensions import register_views

    register_views(t.spark, {"kerbside_taxis": t.all_taxis, "kerbside_drivers": t.drivers})
    return t.spark.sql(
        "SELECT TaxiType, count(*) AS drivers, round(avg(Rating), 6) AS rating FROM kerbside_taxis "
        "JOIN kerbside_drivers ON TaxiID = TaxiIDDriving GROUP BY TaxiType"
    )


# --- decoding --------------------------------------------------------------------------------

@query("dec_json", "SELECT k, count(*) AS n FROM ev GROUP BY k", EV)
def _(t):
    return D.parse_json(t.messages, "k int").groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("dec_json_key", "SELECT 'user-' || user_id AS user, k FROM ev", EV)
def _(t):
    return D.parse_keyed_json(t.messages, "k int", "user")


@query(
    "dec_nested",
    "SELECT 'C' || user_id AS customerId, 'E' || event_id AS eventId, event_id AS eventOffset, "
    "event_id % 4 AS devices FROM ev",
    EV,
)
def _(t):
    parsed = D.parse_json(t.device_messages, schemas.DEVICE_EVENT)
    return parsed.select("customerId", "eventId", "eventOffset", F.size("data.devices").alias("devices"))


@query("dec_explode", "SELECT * FROM devices", ("devices",))
def _(t):
    return D.flatten_devices(D.parse_json(t.device_messages, schemas.DEVICE_EVENT))


@query(
    "dec_avro",
    "SELECT event_id AS offset, CAST(user_id % 2 + 7 AS INTEGER) AS schema_id, props AS payload, user_id % 2 = 0 AS known FROM ev",
    EV,
)
def _(t):
    framed = t.messages.withColumn(
        "value", F.expr("concat(unhex('00'), unhex(lpad(hex(substring(cast(key as string), 6) % 2 + 7), 8, '0')), value)")
    )
    parts = D.split_confluent(framed)
    payload = F.col("payload").cast("string").alias("payload")
    return parts.select("offset", "schema_id", payload, D.known_schema([7]).alias("known"))


@query(
    "dec_encode",
    "SELECT booking_id AS key, booking_id, passenger_id, estimated_distance, special_requirements FROM bookings",
    ("bookings",),
)
def _(t):
    sent = t.bookings.select("booking_id", "passenger_id", "estimated_distance", "special_requirements")
    layout = "booking_id string, passenger_id long, estimated_distance double, special_requirements string"
    return D.parse_json(D.to_message(sent, "booking_id"), layout, keep=("key",))


_SECOND = "make_timestamp(epoch_us(et) // 1000000 * 1000000)"


@query("dec_ts_iso", f"SELECT event_id, {_SECOND} AS at FROM ev", EV)
def _(t):
    text = t.events.select("event_id", F.date_format("et", "yyyy-MM-dd'T'HH:mm:ss").alias("at"))
    return D.event_time(text, "at")


@query(
    "dec_ts_fmt",
    f"SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN {_SECOND} END AS at FROM ev",
    EV,
)
def _(t):
    good = F.date_format("et", D.SECONDS)
    text = t.events.select("event_id", F.when(F.col("event_id") % 9 == 0, "not a time").otherwise(good).alias("at"))
    return D.event_time(text, "at", D.SECONDS)


@query("dec_ts_micros", f"SELECT event_id, CASE WHEN event_id % 2 = 0 THEN et ELSE {_SECOND} END AS at FROM ev", EV)
def _(t):
    whole, short = F.date_format("et", D.MICROS), F.date_format("et", "yyyy-MM-dd'T'HH:mm:ss")
    text = t.events.select("event_id", F.when(F.col("event_id") % 2 == 0, whole).otherwise(short).alias("at"))
    return D.event_time(text, "at", D.MICROS)


@query("dec_ts_epochms", "SELECT event_id, make_timestamp(epoch_us(et) // 1000 * 1000) AS at FROM ev", EV)
def _(t):
    return D.epoch_ms(t.events.select("event_id", F.unix_millis("et").alias("at")), "at")


@query("dec_ts_cast", f"SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN {_SECOND} END AS at FROM ev", EV)
def _(t):
    good = F.date_format("et", D.SECONDS)
    text = t.events.select("event_id", F.when(F.col("event_id") % 9 == 0, "?").otherwise(good).alias("at"))
    return D.cast_time(text, "at")


# --- validation ------------------------------------------------------------------------------

def _readings(t):
    """Sensor readings, some incomplete or out of range."""
    return t.events.selectExpr(
        "concat('r', event_id) AS reading_id",
        "CASE WHEN event_id % 50 <> 0 THEN concat('sensor-', user_id) END AS sensor_id",
        "concat('zone-', user_id % 4) AS location",
        "value - 60 AS temperature",
        "k * 1.25D AS humidity",
        "unix_millis(et) AS timestamp",
    )


_READINGS = (
    "(SELECT 'r' || event_id AS reading_id, CASE WHEN event_id % 50 <> 0 THEN 'sensor-' || user_id END AS sensor_id, "
    "'zone-' || (user_id % 4) AS location, value - 60 AS temperature, k * 1.25::DOUBLE AS humidity, "
    "epoch_us(et) // 1000 AS timestamp FROM ev)"
)
_FINE = "sensor_id IS NOT NULL AND temperature >= -50 AND temperature <= 100 AND humidity <= 100 AND humidity >= 0"


@query("val_sensor", f"SELECT * FROM {_READINGS} WHERE {_FINE}", EV)
def _(t):
    return V.validate_sensor(_readings(t))[0]


@query(
    "val_quarantine",
    "SELECT reading_id, CASE WHEN sensor_id IS NULL THEN 'missing sensor_id' "
    "WHEN temperature < -50 OR temperature > 100 THEN 'temperature out of range' "
    f"ELSE 'humidity out of range' END AS reject_reason FROM {_READINGS} WHERE NOT ({_FINE})",
    EV,
)
def _(t):
    return V.validate_sensor(_readings(t))[1].select("reading_id", V.REASON)


@query("alert_high", f"SELECT reading_id, sensor_id, temperature FROM {_READINGS} WHERE temperature > 35", EV)
def _(t):
    return V.high_temp(_readings(t)).select("reading_id", "sensor_id", "temperature")


@query(
    "val_tweet",
    "SELECT tweet_id, ltrim(user_handle, '@') AS user_handle, coalesce(language, 'en') AS language, created_at, "
    "coalesce(retweet_count, 0) AS retweet_count, coalesce(like_count, 0) AS like_count FROM tweets",
    ("tweets",),
)
def _(t):
    return V.normalise_tweet(t.tweets).drop("text")


@query(
    "val_numeric",
    "SELECT event_id, value AS number FROM events WHERE event_id % 3 <> 0",
)
def _(t):
    padded = F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" "))
    wordy = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(padded)
    return V.numeric_only(t.table("events").select("event_id", wordy.alias("value"))).select("event_id", "number")


def _app_events(t):
    """App event messages: some without a page, some cut off."""
    body = (
        "to_json(named_struct('event_id', concat('event-', event_id), 'event_type', event_type, "
        "'user_id', cast(user_id as string), 'page', CASE WHEN event_id % 5 <> 0 THEN concat('/p', user_id % 7) END))"
    )
    return t.events.selectExpr(
        "cast(user_id % 3 as int) AS partition",
        "event_id AS offset",
        f"cast(CASE WHEN event_id % 11 = 0 THEN concat('oops ', event_id) ELSE {body} END as binary) AS value",
    )


@query(
    "evt_format",
    "SELECT user_id % 3 AS partition, event_id AS offset, "
    "CASE WHEN bad THEN '?' ELSE left('event-' || event_id, 8) END AS event_id, "
    "CASE WHEN bad THEN 'unknown' ELSE event_type END AS event_type, "
    "CASE WHEN bad THEN '?' ELSE CAST(user_id AS VARCHAR) END AS user_id, "
    "CASE WHEN bad OR event_id % 5 = 0 THEN '?' ELSE '/p' || (user_id % 7) END AS page, '' AS ts, "
    "CASE WHEN bad THEN 'oops ' || event_id END AS raw FROM (SELECT *, event_id % 11 = 0 AS bad FROM ev)",
    EV,
)
def _(t):
    return D.event_view(_app_events(t), schemas.APP_EVENT)


@query(
    "sen_derive",
    "SELECT 'sensor_' || (event_id % 3 + 1) AS sensor_id, et AS creation_time FROM ev",
    EV,
)
def _(t):
    ticks = t.events.selectExpr("event_id AS value", "et AS timestamp")
    return D.derive_sensor(ticks, seed=7).drop("temperature")


# --- scalar functions ------------------------------------------------------------------------

@query("sc_select", "SELECT c_custkey AS id, c_name AS name, c_acctbal * 2 AS doubled FROM customer")
def _(t):
    renamed = t.table("customer").withColumnRenamed("c_custkey", "id").drop("c_nationkey", "c_mktsegment")
    packed = renamed.select(F.struct("id", F.col("c_name").alias("name")).alias("who"), "c_acctbal")
    return C.project(packed, "who.*", (F.col("c_acctbal") * 2).alias("doubled"))


@query(
    "sc_filter",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_quantity > 45 OR l_discount = 0) "
    "AND l_returnflag <> 'N' AND l_shipdate IS NOT NULL",
)
def _(t):
    many = (F.col("l_quantity") > 45) | (F.col("l_discount") == 0)
    kept = t.table("lineitem").filter(many & (F.col("l_returnflag") != "N") & F.col("l_shipdate").isNotNull())
    return kept.select("l_orderkey", "l_linenumber", "l_quantity")


@query("sc_having", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) >= 65")
def _(t):
    return C.having(t.table("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), "n >= 65")


@query(
    "sc_case",
    "SELECT p_partkey, CASE WHEN p_size > 40 THEN 'large' WHEN p_size > 20 THEN 'medium' ELSE 'small' END AS class FROM part",
)
def _(t):
    size = F.col("p_size")
    return t.table("part").select("p_partkey", C.case([(size > 40, "large"), (size > 20, "medium")], "small").alias("class"))


@query(
    "sc_in_between",
    "SELECT event_id, event_type IN ('view', 'click') AS seen, hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19 "
    "AS rush FROM events",
)
def _(t):
    return t.table("events").select(
        "event_id", C.in_set("event_type", ["view", "click"]).alias("seen"), C.hours(F.hour("ts"), (7, 9), (17, 19)).alias("rush")
    )


@query(
    "sc_coalesce",
    "SELECT trip_id, event_timestamp, coalesce(late_by_minutes, 0) AS late_by_minutes, "
    "coalesce(is_late_data, false) AS is_late_data FROM trips_events",
    ("trips_events",),
)
def _(t):
    filled = C.defaults(t.trips_events, {"late_by_minutes": 0, "is_late_data": False})
    return filled.select("trip_id", "event_timestamp", "late_by_minutes", "is_late_data")


@query(
    "sc_arith",
    "SELECT l_orderkey, l_linenumber, (l_extendedprice * (1 - l_discount)) * (1 + l_tax) AS charge, "
    "l_extendedprice / l_quantity AS unit, l_orderkey % 7 AS rest FROM lineitem",
)
def _(t):
    price = F.col("l_extendedprice")
    return t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"),
        C.ratio(price, "l_quantity").alias("unit"),
        (F.col("l_orderkey") % 7).alias("rest"),
    )


@query(
    "sc_round",
    "SELECT event_id, "
    + ", ".join(f"{half_up('value / 7', digits)} AS r{digits}" for digits in range(4))
    + " FROM events",
)
def _(t):
    seventh = F.col("value") / 7
    return t.table("events").select("event_id", *[F.round(seventh, digits).alias(f"r{digits}") for digits in range(4)])


@query(
    "sc_tsdiff",
    "SELECT booking_id, epoch_us(processing_time) // 1000000 - epoch_us(event_time) // 1000000 AS seconds FROM bookings",
    ("bookings",),
)
def _(t):
    return t.bookings.select("booking_id", C.seconds_between("processing_time", "event_time").alias("seconds"))


# Clocks, random ids and sketches differ from run to run; these queries return what is stable and the
# truth of what must hold.
@query("sc_now", "SELECT event_id, ts, true AS stamped FROM events")
def _(t):
    stamped = C.with_processing_time(t.table("events").select("event_id", "ts"))
    passed = F.unix_seconds("processing_time") - F.unix_seconds(F.current_timestamp())
    return stamped.select("event_id", "ts", passed.between(-3600, 0).alias("stamped"))


@query("tm_event_vs_proc", "SELECT booking_id, event_time, true AS later FROM bookings", ("bookings",))
def _(t):
    stamped = C.with_processing_time(t.bookings.select("booking_id", "event_time"))
    return stamped.select("booking_id", "event_time", (F.col("processing_time") > F.col("event_time")).alias("later"))


@query("sc_length", "SELECT doc_id, length(text) AS n FROM documents")
def _(t):
    return t.table("documents").select("doc_id", C.message_length("text").alias("n"))


@query(
    "sc_loglevel",
    "SELECT event_id, CASE WHEN contains(event_type, 'error') THEN 'ERROR' WHEN contains(event_type, 'warn') "
    "THEN 'WARNING' ELSE 'INFO' END AS log_level FROM events",
)
def _(t):
    return t.table("events").select("event_id", C.log_level("event_type").alias("log_level"))


@query(
    "sc_regex",
    "SELECT conv_id, turn, regexp_extract(text, '([0-9]+)', 1) AS number, "
    "CASE WHEN regexp_matches(text, '[0-9]') THEN 'contains_number' ELSE 'text_only' END AS message_type FROM conversations",
)
def _(t):
    return t.table("conversations").select(
        "conv_id", "turn", C.first_number("text").alias("number"), C.message_type("text").alias("message_type")
    )


@query("sc_msgid", "SELECT event_id, true AS well_formed, CAST(1 AS BIGINT) AS holders FROM events")
def _(t):
    named = t.table("events").select("event_id", C.message_id().alias("message_id"))
    return named.groupBy("message_id").agg(F.min("event_id").alias("event_id"), F.count(F.lit(1)).alias("holders")).select(
        "event_id", F.col("message_id").rlike("^msg_[0-9]+_[0-9a-f-]{36}$").alias("well_formed"), "holders"
    )


@query("sc_literal", "SELECT n_nationkey, 'socket' AS source FROM nation")
def _(t):
    return t.table("nation").select("n_nationkey", F.lit("socket").alias("source"))


@query(
    "sc_split_explode",
    "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part",
)
def _(t):
    return C.words(t.table("part"), "p_name", keep=("p_partkey",))


@query(
    "sc_getitem",
    "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[3] AS DOUBLE) AS third FROM embeddings",
)
def _(t):
    vectors = t.table("embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    return vectors.select("vec_id", prob_of("v", 0).alias("first"), prob_of("v", 2).alias("third"))


@query("sc_distinct", "SELECT DISTINCT source FROM documents")
def _(t):
    return C.distinct_values(t.table("documents"), "source")


@query("sc_split_random", "SELECT o_orderkey, CAST(1 AS BIGINT) AS sides, true AS near_share FROM orders")
def _(t):
    train, test = C.split(t.table("orders"), [0.8, 0.2], seed=42, key=["o_orderkey"])
    both = train.select("o_orderkey", F.lit(1).alias("train")).unionByName(test.select("o_orderkey", F.lit(0).alias("train")))
    share = both.agg(F.avg("train")).scalar()
    keys = both.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("sides"))
    # Four standard errors of a share of 0.8 over the orders of the smallest tables.
    return keys.select("o_orderkey", "sides", (F.abs(share - 0.8) < 0.05).alias("near_share"))


# --- text ------------------------------------------------------------------------------------

_SPACE = X.SPACE
_TOKENS = f"string_split_regex(lower(text), '[{_SPACE}]+')"


def _overlap(words) -> str:
    listed = ", ".join(f"'{word}'" for word in words)
    return f"len(list_distinct(list_intersect({_TOKENS}, [{listed}])))"


_SENTIMENT = f"CASE sign({_overlap(X.POSITIVE)} - {_overlap(X.NEGATIVE)}) WHEN 1 THEN 'positive' WHEN -1 THEN 'negative' ELSE 'neutral' END"
_TAGS = "array_to_string(regexp_extract_all(text, '{}([\\p{{L}}\\p{{N}}_]+)', 1), ',')"
_URLS = f"len(regexp_extract_all(text, 'https?://[^{_SPACE}]+'))"
_WORDS = f"len(regexp_extract_all(text, '[^{_SPACE}]+'))"


def _texts(t):
    return t.table("documents").select("doc_id", "text")


@query("tx_hashtags", f"SELECT doc_id, {_TAGS.format('#')} AS tags FROM documents")
def _(t):
    return _texts(t).select("doc_id", X.hashtags("text").alias("tags"))


@query("tx_mentions", f"SELECT doc_id, {_TAGS.format('@')} AS names FROM documents")
def _(t):
    return _texts(t).select("doc_id", X.mentions("text").alias("names"))


@query("tx_urls", f"SELECT page_id, {_URLS.replace('text', 'html')} AS urls FROM pages")
def _(t):
    return t.table("pages").select("page_id", X.url_count("html").alias("urls"))


@query("tx_sentiment", f"SELECT doc_id, {_SENTIMENT} AS label FROM documents")
def _(t):
    return _texts(t).select("doc_id", X.sentiment("text").alias("label"))


@query("tx_words", f"SELECT conv_id, turn, {_WORDS} AS words FROM conversations")
def _(t):
    return t.table("conversations").select("conv_id", "turn", X.word_count("text").alias("words"))


@query(
    "tx_enrich",
    "SELECT tweet_id, ltrim(user_handle, '@') AS user_handle, text, coalesce(language, 'en') AS language, created_at, "
    "coalesce(retweet_count, 0) AS retweet_count, coalesce(like_count, 0) AS like_count, "
    f"{_TAGS.format('#')} AS hashtags, {_TAGS.format('@')} AS mentions, {_URLS} AS url_count, "
    f"{_SENTIMENT} AS sentiment_label, {_WORDS} AS word_count FROM tweets",
    ("tweets",),
)
def _(t):
    return W.enrich_tweets(V.normalise_tweet(t.tweets)).drop("processed_at")


def tweet_messages(t):
    """Tweets as JSON messages; every 17th is cut off in the middle."""
    body = F.to_json(F.struct("*"))
    cut = F.when(F.col("tweet_id").cast("long") % 17 == 0, F.substring(body, 1, 30)).otherwise(body)
    return t.tweets.select(cut.cast("binary").alias("value"))


@query(
    "tx_stats",
    "SELECT count(*) FILTER (ok) AS processed, count(*) FILTER (NOT ok) AS errors, "
    "count(*) FILTER (ok AND label = 'positive') AS positive, count(*) FILTER (ok AND label = 'neutral') AS neutral, "
    "count(*) FILTER (ok AND label = 'negative') AS negative "
    f"FROM (SELECT CAST(tweet_id AS BIGINT) % 17 <> 0 AS ok, {_SENTIMENT} AS label FROM tweets)",
    ("tweets",),
)
def _(t):
    return W.tweet_stats(tweet_messages(t))
