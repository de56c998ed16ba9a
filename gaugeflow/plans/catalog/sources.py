"""Sources, manifests and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions import times, values
from gaugeflow.plans.catalog.base import (
    FILE_OF_EVENT,
    events_csv,
    num,
    query,
    sql_ts,
    staged,
    table,
    ts,
)
from gaugeflow.session import spread
from gaugeflow.sources import documents, features, manifest, records, stations

_EVENT_SQL = f"SELECT event_id, {sql_ts('ts')} AS ts, user_id, event_type, value, props"


def _typed(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("event_id").cast("bigint").alias("event_id"), "ts", F.col("user_id").cast("bigint").alias("user_id"),
        "event_type", F.col("value").cast("double").alias("value"), "props",
    )


@query("scan_csv", f"{_EVENT_SQL} FROM events")
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(records.read_records(spark, events_csv(spark, sf_dir), header=True))


@query(
    "strip_nulls",
    "SELECT doc_id, md5(concat(text, lang)) AS digest, length(concat(text, lang)) AS n FROM documents",
)
def strip_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    nul = F.char(F.lit(0))
    dirty = d.select("doc_id", F.concat(nul, "text", nul, nul, "lang", nul).alias("t"))
    return records.strip_nulls(dirty).select(
        "doc_id", F.md5(F.col("t").cast("binary")).alias("digest"), F.length("t").cast("bigint").alias("n")
    )


@query(
    "row_skip",
    f"""SELECT event_id, ts, line AS src_line FROM (
          SELECT event_id, {sql_ts("ts")} AS ts, row_number() OVER (PARTITION BY {FILE_OF_EVENT} ORDER BY event_id) AS line
          FROM events) WHERE line > 3""",
)
def row_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = records.number_lines(records.read_records(spark, events_csv(spark, sf_dir), header=True))
    kept = records.skip_rows(numbered, 3)
    return kept.select(F.col("event_id").cast("bigint").alias("event_id"), "ts", "src_line")


@query(
    "row_limit",
    f"""SELECT event_id FROM (
          SELECT event_id, row_number() OVER (PARTITION BY {FILE_OF_EVENT} ORDER BY event_id) AS line FROM events)
        WHERE line > 3 ORDER BY event_id LIMIT 777""",
)
def row_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = records.take_rows(records.read_records(spark, events_csv(spark, sf_dir), header=True), skip=3, limit=777)
    return kept.select(F.col("event_id").cast("bigint").alias("event_id"))


# Each event type writes its own columns in its own order; errors have a cell more than titles in every second record.
_LAYOUTS = {
    "click": ["event_id", "value", "user_id"],
    "view": ["user_id", "event_id", "value"],
    "purchase": ["value", "user_id", "event_id", "seq"],
    "error": ["event_id", "user_id"],
    "signup": ["event_id", "value", "user_id"],
}


def _layout_files(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        e = table(spark, sf_dir, "events").withColumn("seq", F.lit("s"))
        number = F.col("value").cast("decimal(18,2)").cast("string")
        for name, columns in _LAYOUTS.items():
            cells = [number if c == "value" else F.col(c).cast("string") for c in columns]
            line = F.concat_ws(",", *cells)
            if name == "error":  # a quoted cell without a title
                line = F.when(F.col("event_id") % 2 == 0, F.concat(line, F.lit(',"v, ""'), number, F.lit('"""'))).otherwise(line)
            rows = e.filter(F.col("event_type") == name).select(line.alias("line"))
            head = spark.createDataFrame([(",".join(columns),)], "line string")
            head.unionByName(rows).coalesce(1).write.text(f"{path}/{name}")

    return staged(spark, sf_dir, "layouts", write)


_LAYOUT_COLUMNS = """event_id, event_type, CASE WHEN event_type <> 'error' THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) ELSE '' END AS value,
    CAST(user_id AS VARCHAR) AS user_id, CASE WHEN event_type = 'purchase' THEN 's' ELSE '' END AS seq_title"""


@query("scan_headers", f"SELECT {_LAYOUT_COLUMNS} FROM events")
def scan_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with different titles in different orders, one of them a name of the library's own."""
    rows = records.number_lines(records.read_records(spark, _layout_files(spark, sf_dir), header=True))
    kind = F.regexp_extract("src_file", r"/([a-z]+)/[^/]*$", 1)
    return rows.select(F.col("event_id").cast("bigint").alias("event_id"), kind.alias("event_type"), "value", "user_id", F.col("seq_").alias("seq_title"))


@query(
    "scan_ragged",
    """WITH l AS (SELECT *, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS v FROM events)
       SELECT event_id, CASE event_type WHEN 'view' THEN CAST(user_id AS VARCHAR) WHEN 'purchase' THEN v ELSE CAST(event_id AS VARCHAR) END AS first,
              CASE event_type WHEN 'view' THEN v WHEN 'purchase' THEN CAST(event_id AS VARCHAR) WHEN 'error' THEN
                   CASE WHEN event_id % 2 = 0 THEN concat('v, "', v, '"') ELSE '' END ELSE CAST(user_id AS VARCHAR) END AS third,
              CASE event_type WHEN 'purchase' THEN 4 WHEN 'error' THEN 3 - event_id % 2 ELSE 3 END AS n FROM l""",
)
def scan_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files by number: every cell of every record in its file's order."""
    rows = records.read_records(spark, _layout_files(spark, sf_dir), header=True)
    return rows.select(
        F.col("event_id").cast("bigint").alias("event_id"), F.get("cells", F.lit(0)).alias("first"),
        F.coalesce(F.get("cells", F.lit(2)), F.lit("")).alias("third"), F.size("cells").cast("bigint").alias("n"),
    )


@query("charset_detect", "SELECT event_id, concat(event_type, ' µ') AS event_type, value FROM events")
def charset_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors and purchases arrive in UTF-16 with a byte order mark, the rest in UTF-8."""

    def write(path: str) -> None:
        e = table(spark, sf_dir, "events").select(
            "event_id", F.concat("event_type", F.lit(" µ")).alias("event_type"), "value"
        )
        wide = F.col("event_type").startswith("error") | F.col("event_type").startswith("purchase")
        e.filter(wide).write.option("header", True).option("encoding", "UTF-16").csv(f"{path}/wide")
        e.filter(~wide).write.option("header", True).csv(f"{path}/plain")

    path = staged(spark, sf_dir, "charset", write)
    rows = records.read_detected(spark, path, header=True)
    return rows.select(
        F.col("event_id").cast("bigint").alias("event_id"), "event_type", F.col("value").cast("double").alias("value")
    )


@query("manifest_fixed", "SELECT trim(url) AS url, 0 AS ord FROM pages")
def manifest_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(manifest.fixed_url(F.col("url")).alias("m")).select("m.*")


@query(
    "manifest_combinations",
    """SELECT p_partkey, concat('https://data.example/', p_brand, '/', a.v, '/', b.v, '.csv') AS url,
              CAST(a.i + 3 * b.i AS BIGINT) AS ord
       FROM part,
            (VALUES ('north', 0), ('south', 1), ('west', 2)) AS a(v, i),
            LATERAL (SELECT unnest([p_type, p_name]) AS v, unnest([0, 1]) AS i) AS b""",
)
def manifest_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    base = F.concat(F.lit("https://data.example/"), "p_brand", F.lit("/{a}/{b}.csv"))
    sets = [("{a}", manifest.values_static(["north", "south", "west"])), ("{b}", F.array("p_type", "p_name"))]
    return manifest.manifest_combinations(p, base, sets, block=4).select("p_partkey", "url", "ord")


@query(
    "values_static",
    "SELECT p_partkey, v.pos, v.value FROM part, (VALUES (0, 'hourly'), (1, 'daily'), (2, 'weekly')) AS v(pos, value)",
)
def values_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.posexplode(manifest.values_static(["hourly", "daily", "weekly"])).alias("pos", "value"))


@query(
    "values_time_strings",
    """SELECT event_id, CAST(i AS INTEGER) AS pos,
              strftime(date_trunc('hour', ts) - INTERVAL 24 HOUR + INTERVAL 1 HOUR + to_hours(6 * i), '%Y%m%d%H%M%S') AS value
       FROM events, range(4) AS r(i)""",
)
def values_time_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time strings a run at each event's time would ask for."""
    e = table(spark, sf_dir, "events")
    strings = manifest.values_time_strings(F.col("ts"), minus=24, count=4, delta=6, zone="+01:00")
    return e.select("event_id", F.posexplode(strings).alias("pos", "value"))


@query(
    "manifest_expand",
    """SELECT parent, pos, url FROM (
         SELECT url AS parent, CAST(0 AS INTEGER) AS pos, url AS url FROM pages UNION ALL
         SELECT url, 1, concat(regexp_extract(url, '^[a-z]+://[^/?#]*'), '/root%20file.csv') FROM pages UNION ALL
         SELECT url, 2, concat(regexp_extract(url, '^.*/'), 'p', page_id, '.csv') FROM pages UNION ALL
         SELECT url, 3, concat('http://mirror.example/', page_id, '.csv') FROM pages)""",
)
def manifest_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing per page: its own link, one from the host root, one beside it, one inside a tag."""
    p = table(spark, sf_dir, "pages")
    page = F.col("page_id").cast("string")
    text = F.concat(
        "url", F.lit("\n\n /root file.csv ;"), F.concat(F.lit("p"), page, F.lit(".csv\n")),
        F.lit("readme.txt\n"), F.lit("<a=http://mirror.example/"), page, F.lit(".csv"),
    )
    listings = p.select(F.col("url").alias("parent"), text.alias("text"))
    return manifest.manifest_expand(listings, splitter="\\n;", regex=r".*\.txt", remove=True)


def _json_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents ``{"rows": [...]}`` of at most 1000 events per user; ``part`` numbers them."""
    e = table(spark, sf_dir, "events")
    element = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("DATAORA"), F.col("value").alias("VALORE"),
        F.col("event_type").alias("type"), F.col("event_id").alias("id"),
    )
    grouped = e.groupBy("user_id", F.floor(F.col("event_id") / 1000).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("o"), element.alias("e")))).alias("es")
    )
    return grouped.select(
        "user_id", "part", F.to_json(F.struct(F.transform("es", lambda x: x["e"]).alias("rows"))).alias("doc")
    )


@query(
    "json_observations",
    f"SELECT user_id, {sql_ts('ts')} AS phen_start, value AS result FROM events",
)
def json_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = documents.explode_json_observations(
        _json_docs(spark, sf_dir), ["user_id"], "rows", "DATAORA", "VALORE", times.parse_iso, values.parse_number
    )
    return out.select("user_id", ts("phen_start").alias("phen_start"), num("result").alias("result"))


@query(
    "json_vector_join",
    f"""WITH s AS (SELECT user_id, date_trunc('day', ts) AS t, value, event_id,
                     CASE WHEN event_type IN ('click', 'view', 'signup') THEN 0 ELSE 1 END AS doc FROM events),
            l AS (SELECT user_id, t, doc, arg_max(value, event_id) AS v FROM s GROUP BY ALL)
       SELECT a.user_id, {sql_ts("a.t")} AS phen_start,
              concat(CAST(a.v AS DECIMAL(18,2)), ',', CAST(b.v AS DECIMAL(18,2))) AS results
       FROM l a JOIN l b ON a.user_id = b.user_id AND a.t = b.t AND a.doc = 0 AND b.doc = 1""",
)
def json_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two documents per user, joined on the day."""
    first = F.col("event_type").isin("click", "view", "signup")
    e = table(spark, sf_dir, "events")
    element = F.struct(
        F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("DATAORA"),
        F.col("value").alias("VALORE"),
    )
    docs = e.groupBy(
        "user_id", F.when(first, 0).otherwise(1).alias("doc_no"), F.floor(F.col("event_id") / 1000).alias("part")
    ).agg(F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("o"), element.alias("e")))).alias("es"))
    docs = docs.select("user_id", "doc_no", "part", F.to_json(F.struct(F.transform("es", lambda x: x["e"]).alias("rows"))).alias("doc"))
    observations = documents.explode_json_observations(
        docs, ["user_id", "doc_no", "part"], "rows", "DATAORA", "VALORE", times.parse_iso, values.parse_number
    ).withColumn("pos", F.struct("part", "pos"))
    out = documents.zip_json_documents(observations, ["user_id"], "doc_no", 2)
    text = F.array_join(F.transform("results", lambda v: v.cast("decimal(18,2)").cast("string")), ",")
    return out.select("user_id", ts("phen_start").alias("phen_start"), text.alias("results"))


_ARRAY_PART = 40


@query(
    "column_arrays",
    f"""WITH n AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS line FROM events),
            c AS (SELECT user_id, CAST(line // {_ARRAY_PART} AS BIGINT) AS part, line, t.ty, t.c,
                         CASE WHEN event_type = t.ty THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS v
                  FROM n, (VALUES ('click', 0), ('view', 1), ('error', 2)) AS t(ty, c)),
            u AS (SELECT user_id, c, dense_rank() OVER (PARTITION BY user_id ORDER BY c) AS no
                  FROM (SELECT DISTINCT user_id, c FROM c WHERE v IS NOT NULL))
       SELECT c.user_id, concat('stream-', u.no) AS ds_id, c.part,
              string_agg(coalesce(c.v, 'null'), ',' ORDER BY c.line) AS "values"
       FROM c JOIN u ON c.user_id = u.user_id AND c.c = u.c GROUP BY c.user_id, u.no, c.part""",
)
def column_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events are a document with one column per event type and one empty column."""
    e = table(spark, sf_dir, "events")
    cell = F.col("value").cast("decimal(18,2)").cast("string")
    doc = e.select(
        "user_id", F.col("event_id").alias("seq"),
        *[F.when(F.col("event_type") == t, cell).otherwise("").alias(t) for t in ("click", "none", "view", "error")],
    )
    out = documents.columns_to_arrays(
        doc, ["user_id"], ["click", "none", "view", "error"], [values.parse_decimal],
        ["stream-1", "stream-2", "stream-3"], part_size=_ARRAY_PART,
    )
    text = F.array_join(F.transform("values", lambda v: v.cast("decimal(18,2)").cast("string")), ",", "null")
    return out.select("user_id", "ds_id", "part", text.alias("values"))


def _swe_docs(spark: SparkSession, sf_dir: str, about: DataFrame | None = None) -> DataFrame:
    """A data array of two blocks per order, with comma decimals.

    ``about``, columns by ``o_orderkey``, is joined before the documents are built: none of them is shuffled or sorted.
    """
    o = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    passed = ["o_orderkey"]
    if about is not None:
        o = o.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus").join(about, "o_orderkey")
        passed = about.columns
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"

    def block(i: int):
        number = F.replace((F.col("o_totalprice") + i).cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
        start = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(i))
        end = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(i + 1))
        return F.concat_ws(";", F.date_format(start, iso), F.date_format(end, iso), F.lit("1"), number)

    head = (
        '<om:result xmlns:om="urn:om" xmlns:swe="urn:swe" xmlns:xlink="urn:xlink"><swe:DataArray>'
        "<swe:elementCount><swe:Count><swe:value>2</swe:value></swe:Count></swe:elementCount>"
        '<swe:elementType name="Components"><swe:DataRecord>'
        '<swe:field name="StartTime"><swe:Time/></swe:field><swe:field name="EndTime"><swe:Time/></swe:field>'
        '<swe:field name="Validity"><swe:Category/></swe:field>'
        '<swe:field name="Value"><swe:Quantity><swe:uom xlink:href="http://units.example/uom/'
    )
    middle = (
        '"/></swe:Quantity></swe:field></swe:DataRecord></swe:elementType><swe:encoding>'
        '<swe:TextEncoding decimalSeparator="," blockSeparator="@@" tokenSeparator=";"/></swe:encoding><swe:values>'
    )
    tail = "</swe:values></swe:DataArray></om:result>"
    unit = F.when(F.col("o_orderstatus") == "O", "mg.m-3").otherwise("ug.m-3")
    xml = F.concat(F.lit(head), unit, F.lit(middle), block(0), F.lit("@@"), block(1), F.lit("@@"), F.lit(tail))
    return o.select(*passed, xml.alias("xml"))


@query(
    "swe_explode",
    f"""SELECT o_orderkey, CAST(i AS INTEGER) AS pos, {sql_ts("o_orderdate + to_hours(i)")} AS phen_start,
               {sql_ts("o_orderdate + to_hours(i + 1)")} AS phen_end, round(o_totalprice + i, 2) AS result_num,
               CASE WHEN o_orderstatus = 'O' THEN 'mg.m-3' ELSE 'ug.m-3' END AS unit_symbol
        FROM orders, range(2) AS r(i)""",
)
def swe_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = documents.explode_swe(_swe_docs(spark, sf_dir)).filter(F.col("reject").isNull())
    return out.select(
        "o_orderkey", "pos", ts("phen_start").alias("phen_start"), ts("phen_end").alias("phen_end"),
        num("result_num", 2).alias("result_num"), "unit_symbol",
    )


@query(
    "response_features",
    """SELECT o_orderkey, CASE WHEN s_suppkey IS NOT NULL THEN concat('f-', s_suppkey) END AS foi_id,
              CASE WHEN s_suppkey IS NULL THEN 'FeatureOfInterest not found' END AS response_reject
       FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey""",
)
def response_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses name the supplier of the order's customer number as their feature, which may not exist."""
    owner = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("owner"))
    head = F.concat(F.lit('<om:featureOfInterest xlink:href="http://x.example/SAM.'), "owner", F.lit('"/>'))
    docs = _swe_docs(spark, sf_dir, owner).withColumn("xml", F.concat(head, "xml"))
    key = F.col("s_suppkey").cast("string")
    foi = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("SAM."), key).alias("local_id"), F.concat(F.lit("f-"), key).alias("foi_id")
    )
    out = documents.attach_feature(docs, foi, "owner", spread="o_orderkey")
    return out.select("o_orderkey", "foi_id", "response_reject")


_PER_TEXT_FILE = 500_000


def _write_text(spark: SparkSession, sf_dir: str, name: str, df: DataFrame, dealt: bool = False) -> str:
    """Text files of at most so many rows, compressed. ``dealt``: the rows come from a shuffle, which isn't run to count its parts."""

    def write(path: str) -> None:
        rows = df if dealt else spread(df, "value")
        rows.write.option("compression", "gzip").option("maxRecordsPerFile", _PER_TEXT_FILE).text(path)

    return staged(spark, sf_dir, name, write)


_NS = (
    'xmlns:aqd="urn:aqd" xmlns:ef="urn:ef" xmlns:gml="urn:gml" xmlns:base="urn:base" xmlns:sams="urn:sams" '
    'xmlns:xlink="urn:xlink" xmlns:ompr="urn:ompr" xmlns:base2="urn:base2" xmlns:gmd="urn:gmd"'
)


def _activity(flag: Column) -> Column:
    return F.concat(
        F.lit(
            "<ef:operationalActivityPeriod><ef:OperationalActivityPeriod><ef:activityTime><gml:TimePeriod>"
            '<gml:beginPosition>2010-01-01</gml:beginPosition><gml:endPosition indeterminatePosition="'
        ),
        flag,
        F.lit(
            '"></gml:endPosition></gml:TimePeriod></ef:activityTime></ef:OperationalActivityPeriod>'
            "</ef:operationalActivityPeriod>"
        ),
    )


def station_files(spark: SparkSession, sf_dir: str) -> str:
    """Customers as station features; those with a negative balance are no longer active."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    position = F.concat_ws(
        " ", (F.col("c_nationkey") + 40 + F.lit(0.123456)).cast("decimal(18,6)").cast("string"),
        (F.col("c_nationkey") + F.lit(0.654321)).cast("decimal(18,6)").cast("string"),
    )
    xml = F.concat(
        F.lit(f'<aqd:AQD_Station {_NS} gml:id="STA.'), key,
        F.lit('"><ef:inspireId><base:Identifier><base:namespace>AT.</base:namespace></base:Identifier></ef:inspireId><ef:name>'),
        F.col("c_name"), F.lit("</ef:name>"), _activity(F.when(F.col("c_acctbal") < 0, "now").otherwise("unknown")),
        F.lit('<ef:geometry><gml:Point srsName="urn:ogc:def:crs:EPSG::4326" srsDimension="2"><gml:pos>'), position,
        F.lit("</gml:pos></gml:Point></ef:geometry></aqd:AQD_Station>"),
    )
    return _write_text(spark, sf_dir, "stations_xml", c.select(xml.alias("value")))


def stations_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = features.read_features(spark, station_files(spark, sf_dir), "aqd:AQD_Station", features.STATION)
    return features.read_stations(feats, "owner", "link")


@query(
    "feature_stations",
    """SELECT concat('STA.', c_custkey) AS local_id, c_name AS name, concat('Air quality station ', c_name) AS description,
              'AT' AS country, CAST(c_nationkey + 0.654321 AS DOUBLE) AS lon, CAST(c_nationkey + 40.123456 AS DOUBLE) AS lat
       FROM customer WHERE c_acctbal >= 0""",
)
def feature_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations_df(spark, sf_dir).select(
        "local_id", "name", "description", F.element_at("properties", F.lit("countryCode")).alias("country"), "lon", "lat"
    )


# Pollutant codes given to parts by size; 99 is none of the known ones.
_CODE_CASE = "CASE p_size % 4 WHEN 0 THEN '1' WHEN 1 THEN '5' WHEN 2 THEN '8' ELSE '99' END"


def _part_code():
    size = F.col("p_size") % 4
    return F.when(size == 0, "1").when(size == 1, "5").when(size == 2, "8").otherwise("99")


def process_files(spark: SparkSession, sf_dir: str) -> str:
    """Parts as process features, each twice with sequence numbers 1 and 2."""
    p = table(spark, sf_dir, "part").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    key = F.col("p_partkey").cast("string")
    measuring = F.when(
        F.col("p_type") == "ECONOMY",
        F.concat(
            F.lit('<aqd:measurementEquipment><aqd:MeasurementEquipment><aqd:equipment xlink:href="http://e.example/'),
            "p_brand", F.lit('"/></aqd:MeasurementEquipment></aqd:measurementEquipment>'),
        ),
    ).otherwise("")
    other = F.when(
        F.col("p_type") == "SMALL", F.concat(F.lit("<aqd:otherEquipment>"), "p_name", F.lit("</aqd:otherEquipment>"))
    ).otherwise("")
    xml = F.concat(
        F.lit(f'<aqd:AQD_SamplingPointProcess {_NS} gml:id="SPP.1.A'), key, F.lit(".7."), _part_code(), F.lit("."),
        F.col("n").cast("string"), F.lit('.1">'),
        F.lit("<ompr:inspireId><base:Identifier><base:namespace>AT.</base:namespace></base:Identifier></ompr:inspireId>"),
        measuring, F.lit('<aqd:samplingEquipment><aqd:SamplingEquipment><aqd:equipment xlink:href="http://s.example/'),
        F.col("p_type"), F.lit('"/>'), other, F.lit("</aqd:SamplingEquipment></aqd:samplingEquipment>"),
        F.lit("<ompr:responsibleParty><base2:RelatedParty><base2:individualName><gmd:LocalisedCharacterString>"),
        F.col("p_name"),
        F.lit("</gmd:LocalisedCharacterString></base2:individualName></base2:RelatedParty></ompr:responsibleParty>"),
        F.lit("</aqd:AQD_SamplingPointProcess>"),
    )
    return _write_text(spark, sf_dir, "processes_xml", p.select(xml.alias("value")))


def processes_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = features.read_features(
        spark, process_files(spark, sf_dir), "aqd:AQD_SamplingPointProcess", features.PROCESS
    )
    return features.read_processes(feats, stations.pollutant_dim(spark), "owner", "link")


@query(
    "feature_processes",
    f"""SELECT concat('SPP.1.A', p_partkey, '.7.', {_CODE_CASE}) AS local_id,
               CASE WHEN p_type = 'ECONOMY' THEN p_brand WHEN p_type = 'SMALL' THEN p_name ELSE p_type END AS name,
               CASE WHEN p_type = 'ECONOMY' THEN concat('http://e.example/', p_brand)
                    ELSE concat('http://s.example/', p_type) END AS description,
               p_name AS individual
        FROM part WHERE {_CODE_CASE} <> '99'""",
)
def feature_processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processes_df(spark, sf_dir).select(
        "local_id", "name", "description",
        F.element_at("properties", F.lit("responsibleParty/individualName")).alias("individual"),
    )


def sample_files(spark: SparkSession, sf_dir: str) -> str:
    """Suppliers as sample features, positions in (longitude, latitude) order."""
    s = table(spark, sf_dir, "supplier")
    position = F.concat_ws(
        " ", (F.col("s_nationkey") + F.lit(0.25)).cast("decimal(18,2)").cast("string"),
        (F.col("s_nationkey") + 40 + F.lit(0.75)).cast("decimal(18,2)").cast("string"),
    )
    xml = F.concat(
        F.lit(f'<aqd:AQD_Sample {_NS} gml:id="SAM.'), F.col("s_suppkey").cast("string"),
        F.lit('"><aqd:inspireId><base:Identifier><base:namespace>AT.</base:namespace></base:Identifier></aqd:inspireId>'),
        F.lit('<sams:shape><gml:Point srsName="EPSG:4326"><gml:pos>'), position,
        F.lit("</gml:pos></gml:Point></sams:shape></aqd:AQD_Sample>"),
    )
    return _write_text(spark, sf_dir, "samples_xml", s.select(xml.alias("value")))


def samples_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = features.read_features(spark, sample_files(spark, sf_dir), "aqd:AQD_Sample", features.SAMPLE)
    return features.read_samples(feats, "owner", "link")


@query(
    "feature_samples",
    """SELECT concat('SAM.', s_suppkey) AS local_id, concat('Air quality sample SAM.', s_suppkey) AS description,
              CAST(s_nationkey + 0.25 AS DOUBLE) AS lon, CAST(s_nationkey + 40.75 AS DOUBLE) AS lat FROM supplier""",
)
def feature_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples_df(spark, sf_dir).select("local_id", "description", "lon", "lat")


def _broken_files(spark: SparkSession, sf_dir: str) -> str:
    """Suppliers as sample features: some cut off inside a tag, some without an id, one file ends within an element."""
    s = table(spark, sf_dir, "supplier")
    number = F.col("s_suppkey")
    attribute = F.when(number % 5 == 0, "").otherwise(F.concat(F.lit(' gml:id="SAM.'), number.cast("string"), F.lit('"')))
    body = F.when(number % 3 == 0, "<aqd:inspireId><base:Identifier>").otherwise('<sams:shape><gml:Point srsName="EPSG:4326"><gml:pos>1 2</gml:pos></gml:Point></sams:shape>')
    xml = F.concat(F.lit(f"<aqd:AQD_Sample {_NS}"), attribute, F.lit(">"), body, F.lit("</aqd:AQD_Sample>"))
    whole = s.select(xml.alias("value"))
    cut = spark.createDataFrame([(f'<aqd:AQD_Sample {_NS} gml:id="CUT"><sams:shape><gml:Point>',)], "value string")
    return staged(spark, sf_dir, "broken_xml", lambda path: whole.unionByName(cut).write.text(path))


@query(
    "feature_rejects",
    """SELECT CASE WHEN s_suppkey % 5 <> 0 THEN concat('SAM.', s_suppkey) END AS local_id,
              CASE WHEN s_suppkey % 3 = 0 THEN 'Unreadable element' ELSE 'Element without id' END AS reject
       FROM supplier WHERE s_suppkey % 3 = 0 OR s_suppkey % 5 = 0 UNION ALL SELECT 'CUT', 'Unreadable element'""",
)
def feature_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_rejects(spark, _broken_files(spark, sf_dir), "aqd:AQD_Sample", features.SAMPLE).select("local_id", "reject")


@query(
    "feature_datastreams",
    f"""WITH j AS (
          SELECT DISTINCT l_partkey, l_suppkey, l_orderkey, l_linenumber, o_custkey, l_returnflag, {_CODE_CASE} AS code,
                 EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o_custkey AND c_acctbal >= 0) AS has_thing, c_name
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
          JOIN customer ON c_custkey = o_custkey)
        SELECT concat('SPO.', l_orderkey, '.', l_linenumber, '.', l_partkey, '.', l_suppkey, '.', l_returnflag) AS local_id,
               CASE WHEN code = '99' OR NOT has_thing THEN NULL ELSE
                 concat(CASE code WHEN '1' THEN 'SO2' WHEN '5' THEN 'PM10' ELSE 'NO2' END, ' as ', c_name) END AS description,
               CASE WHEN code = '99' THEN 'ObservedProperty not found' WHEN NOT has_thing THEN 'Thing not found' END AS reject,
               l_suppkey AS foi
        FROM (SELECT DISTINCT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_returnflag, code, has_thing,
                     CASE WHEN has_thing THEN c_name END AS c_name FROM j)""",
)
def feature_datastreams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sampling points: station from the customer, process from the part, sample from the supplier."""
    li, o, p = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    # Keys in order take a byte or two a row in a file and over 40 in a broadcast table: these are joined by shuffles.
    j = li.join(o.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).join(p.hint("merge"), F.col("l_partkey") == F.col("p_partkey"))

    def text(c: str):
        return F.col(c).cast("string")

    # One row per point before its text is built: the same points without shuffling whole elements.
    j = j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "o_custkey", _part_code().alias("code")).distinct()
    point = F.concat_ws(".", F.lit("SPO"), text("l_orderkey"), text("l_linenumber"), text("l_partkey"), text("l_suppkey"), "l_returnflag")
    xml = F.concat(
        F.lit(f'<aqd:AQD_SamplingPoint {_NS} gml:id="'), F.col("point"),
        F.lit('"><ef:inspireId><base:Identifier><base:namespace>AT.</base:namespace></base:Identifier></ef:inspireId>'),
        _activity(F.lit("unknown")),
        F.lit('<ef:observingCapability><ef:ObservingCapability><ef:featureOfInterest xlink:href="http://x.example/SAM.'),
        text("l_suppkey"), F.lit('"/><ef:observedProperty xlink:href="http://x.example/'), F.col("code"),
        F.lit('"/><ef:procedure xlink:href="http://x.example/SPP.1.A'), text("l_partkey"), F.lit(".7."), F.col("code"),
        F.lit('.1.1"/></ef:ObservingCapability></ef:observingCapability><ef:broader xlink:href="http://x.example/STA.'),
        text("o_custkey"), F.lit('"/></aqd:AQD_SamplingPoint>'),
    )
    rows = j.withColumn("point", point).select(xml.alias("value"))
    path = _write_text(spark, sf_dir, "points_xml", rows, dealt=True)
    feats = features.read_features(spark, path, "aqd:AQD_SamplingPoint", features.SAMPLING_POINT)

    def dim(df: DataFrame, id_col: str) -> DataFrame:
        return df.select("local_id", F.col("local_id").alias(id_col), "name")

    existing = samples_df(spark, sf_dir).select("local_id", F.lit(None).cast("struct<name:string,symbol:string,definition:string>").alias("uom"))
    out = features.read_sampling_points(
        feats, stations.pollutant_dim(spark), dim(processes_df(spark, sf_dir), "sensor_id"),
        dim(stations_df(spark, sf_dir), "thing_id"), dim(samples_df(spark, sf_dir), "foi_id"), existing, "owner", "link",
    )
    return out.select(
        "local_id", "description", "reject", F.regexp_extract("foi_id", r"([0-9]+)$", 1).cast("bigint").alias("foi"),
    )


@query(
    "pollutant_dim",
    """SELECT p_partkey, p.name, p.unit FROM (
         SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN '1' WHEN 1 THEN '7' WHEN 2 THEN '10' WHEN 3 THEN '6001' ELSE '2' END AS code
         FROM part) LEFT JOIN (VALUES ('1', 'SO2', 'µg/m3'), ('7', 'O3', 'µg/m3'), ('10', 'CO', 'mg/m3'), ('6001', 'PM2.5', 'µg/m3'))
         AS p(code, name, unit) USING (code)""",
)
def pollutant_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size") % 5
    code = F.when(size == 0, "1").when(size == 1, "7").when(size == 2, "10").when(size == 3, "6001").otherwise("2")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("http://v.example/aq/pollutant/"), code).alias("link"))
    return stations.with_pollutant(parts, F.col("link")).select(
        "p_partkey", F.col("op_name").alias("name"), F.col("op_unit").alias("unit")
    )


def station_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of a tab-separated station table: one station per customer, point per customer and priority."""

    def write(path: str) -> None:
        o = table(spark, sf_dir, "orders")
        cust = F.col("o_custkey").cast("string")
        given = {
            "Countrycode": F.lit("AT"),
            "Namespace": F.concat(F.lit("NS"), F.col("o_orderstatus")),
            "AirQualityStation": F.concat(F.lit("ST"), cust),
            "SamplingPoint": F.concat_ws("-", F.lit("SP"), cust, F.left("o_orderpriority", F.lit(1))),
            "SamplingProces": F.when(F.col("o_orderstatus") == "P", "").otherwise(F.concat(F.lit("PR"), "o_orderstatus")),
            "AirPollutantCode": F.concat(
                F.lit("http://v.example/pollutant/"), F.when(F.col("o_orderpriority") == "1-URGENT", "1").otherwise("8")
            ),
            "ObservationDateBegin": F.date_format("o_orderdate", "yyyy-MM-dd"),
            "Longitude": F.concat(F.col("o_custkey").cast("string"), F.lit(".1234567")),
            "Latitude": F.lit("48.0000005"),
            "MeasurementEquipment": F.col("o_orderkey").cast("string"),
        }
        rows = o.select(*[given.get(c, F.lit("")).alias(c) for c in stations.STATION_COLUMNS], "o_orderkey")
        rows.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").write.option("header", True).option(
            "sep", "\t"
        ).option("emptyValue", "").csv(path)

    path = staged(spark, sf_dir, "stations_tsv", write)
    rows = records.read_records(spark, path, tab=True, header=True)
    return rows.withColumn("seq", F.col("o_orderkey").cast("bigint"))


_STATION_SQL = """SELECT concat('ST', o_custkey) AS station, concat('SP-', o_custkey, '-', left(o_orderpriority, 1)) AS point,
  CASE WHEN o_orderstatus = 'P' THEN 'Unknown' ELSE concat('PR', o_orderstatus) END AS process,
  concat('NS', o_orderstatus) AS namespace, strftime(o_orderdate, '%Y-%m-%d') AS begun, o_orderkey, o_custkey,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'SO2' ELSE 'NO2' END AS op_name FROM orders"""

_STATION_KEYS = ["AirQualityStation", "SamplingPoint", "SamplingProces"]


@query(
    "station_metadata",
    f"""SELECT station, point, process, namespace, begun FROM ({_STATION_SQL})
        QUALIFY row_number() OVER (PARTITION BY station, point, process ORDER BY o_orderkey DESC) = 1""",
)
def station_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = stations.read_station_metadata(station_tsv(spark, sf_dir), _STATION_KEYS)
    return meta.select(
        F.col("AirQualityStation").alias("station"), F.col("SamplingPoint").alias("point"),
        F.col("SamplingProces").alias("process"), F.col("Namespace").alias("namespace"),
        F.col("ObservationDateBegin").alias("begun"),
    )


def _station_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items naming the station, point and process of a customer and priority; some don't exist."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        F.concat(F.lit("ST"), F.col("o_custkey").cast("string")).alias("AirQualityStation"),
        F.concat_ws("-", F.lit("SP"), F.col("o_custkey").cast("string"), F.when(F.col("l_linenumber") < 6, F.col("l_linenumber").cast("string")).otherwise("x")).alias("SamplingPoint"),
        F.lit("PRF").alias("SamplingProcess"),
        F.when(F.col("l_linestatus") == "O", "mg/m3").otherwise("ug/m3").alias("UNIT"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )


_RECORD_SQL = """SELECT concat('SP-', o_custkey, '-', CASE WHEN l_linenumber < 6 THEN CAST(l_linenumber AS VARCHAR) ELSE 'x' END) AS point,
  CASE WHEN l_linestatus = 'O' THEN 'mg/m3' ELSE 'ug/m3' END AS unit, l_orderkey * 10 + l_linenumber AS seq
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@query(
    "lookup_station",
    f"""SELECT r.seq, r.point, s.station, s.process, s.begun FROM ({_RECORD_SQL}) r LEFT JOIN (
          SELECT * FROM ({_STATION_SQL}) QUALIFY row_number() OVER (PARTITION BY point ORDER BY o_orderkey DESC) = 1) s
        ON r.point = s.point""",
)
def lookup_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = stations.read_station_metadata(station_tsv(spark, sf_dir), _STATION_KEYS)
    out = stations.lookup_station(
        _station_records(spark, sf_dir), meta, "AirQualityStation", "SamplingPoint", "SamplingProcess"
    )
    return out.select(
        "seq", F.col("SamplingPoint").alias("point"), F.col("station.AirQualityStation").alias("station"),
        F.col("station.SamplingProces").alias("process"), F.col("station.ObservationDateBegin").alias("begun"),
    )


@query(
    "station_entities",
    f"""WITH s AS (SELECT * FROM ({_STATION_SQL}) QUALIFY row_number() OVER (PARTITION BY point ORDER BY o_orderkey DESC) = 1),
            r AS (SELECT point, seq, max(unit) AS unit FROM ({_RECORD_SQL}) GROUP BY point, seq),
            j AS (SELECT s.*, r.unit, r.seq FROM r JOIN s ON r.point = s.point)
       SELECT 'thing' AS entity, station AS name, concat('Measurement station ', station) AS description,
              CAST(NULL AS VARCHAR) AS unit, CAST(NULL AS DOUBLE) AS lon FROM j GROUP BY station
       UNION ALL SELECT 'location', station, concat('Location of station ', station), NULL,
              round(o_custkey + 0.123457, 6) FROM j GROUP BY station, o_custkey
       UNION ALL SELECT 'sensor', process, concat('Sensor ', process), NULL, NULL FROM j GROUP BY process
       UNION ALL SELECT 'datastream', point, concat(op_name, ' at ', station), max_by(unit, seq), NULL
              FROM j GROUP BY point, op_name, station""",
)
def station_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = stations.read_station_metadata(station_tsv(spark, sf_dir), _STATION_KEYS)
    rows = _station_records(spark, sf_dir)
    # Records of one order line share their number; a line's unit decides ties the same way everywhere.
    rows = rows.groupBy("AirQualityStation", "SamplingPoint", "SamplingProcess", "seq").agg(F.max("UNIT").alias("UNIT"))
    joined = stations.lookup_station(rows, meta, "AirQualityStation", "SamplingPoint", "SamplingProcess")
    made = stations.derive_station_entities(joined, F.col("UNIT"), "link")
    none = F.lit(None).cast("string")

    def rows_of(entity: str, frame: DataFrame, unit=none, lon=None) -> DataFrame:
        lon = F.lit(None).cast("double") if lon is None else lon
        return frame.select(F.lit(entity).alias("entity"), "name", "description", unit.alias("unit"), lon.alias("lon"))

    return (
        rows_of("thing", made["things"])
        .unionByName(rows_of("location", made["locations"], lon=F.col("lon")))
        .unionByName(rows_of("sensor", made["sensors"]))
        .unionByName(rows_of("datastream", made["datastreams"], unit=F.col("uom.symbol")))
    )


def station_json_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per customer."""
    c = table(spark, sf_dir, "customer")
    row = F.struct(
        F.lit('"Austria"').alias("Country"), F.concat(F.lit('AT"'), F.col("c_custkey").cast("string")).alias("AirQualityStationEoICode"),
        F.col("c_name").alias("AQStationName"), F.col("c_mktsegment").alias("AirQualityStationArea"),
        (F.col("c_acctbal")).alias("Longitude"), F.lit(48.5).alias("Latitude"), F.col("c_nationkey").alias("SamplingMethod"),
        F.lit("").alias("OperationalActivityEnd"), F.col("c_mktsegment").alias("ProcessId"), F.col("c_mktsegment").alias("AssessmentMethodId"),
    )
    return c.select("c_custkey", F.to_json(F.struct(F.array(row).alias("Rows"))).alias("doc"))


@query(
    "station_json",
    """SELECT c_custkey, 'AT' AS country_code, 'Austria' AS country, concat('AT', c_custkey) AS code, c_name AS name,
              c_mktsegment AS area, round(c_acctbal, 2) AS lon, '' AS method FROM customer""",
)
def station_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stations.read_station_json(station_json_docs(spark, sf_dir), ["c_custkey"])
    return out.select(
        "c_custkey", F.col("Countrycode").alias("country_code"), F.col("Country").alias("country"),
        F.col("AirQualityStationEoICode").alias("code"), F.col("AQStationName").alias("name"),
        F.col("AirQualityStationArea").alias("area"), num("Longitude", 2).alias("lon"), F.col("SamplingMethod").alias("method"),
    )


@query(
    "station_json_entities",
    """WITH r AS (SELECT o_custkey, o_orderkey, concat('P-', o_custkey, '-', o_orderstatus) AS point,
                   CASE o_orderstatus WHEN 'O' THEN 'NO2' WHEN 'F' THEN 'CO' ELSE 'other' END AS property FROM orders),
            j AS (SELECT r.*, c_name, c_mktsegment FROM r JOIN customer ON o_custkey = c_custkey WHERE property <> 'other')
       SELECT 'thing' AS entity, c_name AS name, concat('Measurement station ', c_name) AS description FROM j GROUP BY c_name
       UNION ALL SELECT 'location', c_name, concat('Location of station AT', o_custkey) FROM j GROUP BY c_name, o_custkey
       UNION ALL SELECT 'sensor', c_mktsegment, concat('Sensor ', c_mktsegment) FROM j GROUP BY c_mktsegment
       UNION ALL SELECT 'datastream', concat(property, ' at ', c_name), concat(property, ' at ', c_name) FROM j GROUP BY point, property, c_name
       UNION ALL SELECT 'reject', 'ObservedProperty not found', CAST(o_orderkey AS VARCHAR) FROM r WHERE property = 'other'""",
)
def station_json_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = stations.read_station_json(station_json_docs(spark, sf_dir), ["c_custkey"])
    info = info.select("c_custkey", F.struct(*[c for c in info.columns if c != "c_custkey"]).alias("station"))
    o = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    rows = o.select(
        "o_custkey", F.col("o_orderkey").alias("seq"),
        F.concat_ws("-", F.lit("P"), F.col("o_custkey").cast("string"), status).alias("SAMPLINGPOINT_LOCALID"),
        F.when(status == "O", "NO2").when(status == "F", "CO").otherwise("other").alias("PROPERTY"), F.lit("u").alias("UNIT"),
    )
    joined = rows.join(info, F.col("o_custkey") == F.col("c_custkey"), "left")
    made = stations.derive_json_station_entities(joined, "link")
    out = made["rejects"].select(
        F.lit("reject").alias("entity"), F.col("reject").alias("name"), F.col("seq").cast("string").alias("description")
    )
    for entity in ("thing", "location", "sensor", "datastream"):
        out = out.unionByName(made[entity + "s"].select(F.lit(entity).alias("entity"), "name", "description"))
    return out


