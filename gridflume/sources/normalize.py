"""Raw records of providers under canonical names, times and units, with the faults that forbid their use.

Operators here give faults as a column instead of raising, so that a caller can publish, report or stop.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Canonical names of the variables of hourly products.
FORCING_NAMES = {
    "nldas2": {
        "Tair": "air_temperature", "Qair": "specific_humidity", "PSurf": "surface_pressure", "SWdown": "downward_shortwave",
        "LWdown": "downward_longwave", "Wind_E": "wind_u", "Wind_N": "wind_v", "Rainf": "precipitation_depth",
    },
    "hrrr": {
        "TMP_2maboveground": "air_temperature", "SPFH_2maboveground": "specific_humidity", "PRES_surface": "surface_pressure", "DSWRF_surface": "downward_shortwave",
        "DLWRF_surface": "downward_longwave", "UGRD_10maboveground": "wind_u", "VGRD_10maboveground": "wind_v", "APCP_surface": "precipitation_depth",
    },
}
ORIENTATION = {"nldas2": "earth_relative", "hrrr": "grid_relative"}
# Canonical names of the daily elements.
DAILY_NAMES = {"tmin": "daily_minimum_temperature", "tmax": "daily_maximum_temperature", "tmean": "daily_midpoint_temperature", "ppt": "daily_precipitation_depth"}
# Offset of degrees Celsius, millimetres in an inch, the provider's mark of a missing value, and hours of fixed Pacific time.
KELVIN, INCH, ABSENT, PACIFIC = 273.15, 25.4, -9999.0, "INTERVAL 8 HOURS"


def forcing(raw: DataFrame, product: str, keys: list[str], stamp: Column, valid_time: Column) -> DataFrame:
    """The product's variables under canonical names at one valid time; ``matches`` counts the rows of that time.

    Fields are null where a key has no row or several of that time.
    """
    names = FORCING_NAMES[product]
    at = F.coalesce(stamp == valid_time, F.lit(False))
    row = F.struct(*(F.col(a).alias(b) for a, b in names.items()))
    found = raw.groupBy(*keys).agg(F.count_if(at).alias("matches"), F.max(F.when(at, row)).alias("_row"))
    return found.select(*keys, "matches", *(F.when(F.col("matches") == 1, F.col(f"_row.{n}")).alias(n) for n in names.values()), F.lit(ORIENTATION[product]).alias("wind_orientation"))


def daily_element(raw: DataFrame, day: Column, element: Column, value: Column) -> DataFrame:
    """A day that ends at 12 UTC: its stamp and bounds, the element's canonical name, and the value in mm or K.

    An unknown element has no name and no value.
    """
    noon = day.cast("timestamp") + F.expr("INTERVAL 12 HOURS")
    name = F.create_map(*(F.lit(x) for pair in DAILY_NAMES.items() for x in pair))[element]
    rain = element == "ppt"
    return raw.withColumns({
        "name": name, "valid_time": noon, "period_start": noon - F.expr("INTERVAL 1 DAY"), "period_end": noon,
        "value": F.when(rain, value).when(name.isNotNull(), value + KELVIN), "units": F.when(rain, "mm").when(name.isNotNull(), "K"),
    })


def snow(rows: DataFrame, tasks: DataFrame) -> DataFrame:
    """Snow-water records of the requests they answer: a row per series and stamp, in UTC and mm.

    ``rows``: station_id, sensor_number, duration_code, units, date, obs_date, value, data_flag (as given).
    ``tasks``: the first three, request_start, request_end. Records up to two days beyond the request are
    cropped. ``fault``: ``identity`` (no such request, or not in inches), ``outside`` (beyond that), ``conflict`` (records of
    one stamp differ; the least is shown).
    """
    keys = ["station_id", "sensor_number", "duration_code"]
    form = F.lit("yyyy-MM-dd HH:mm")
    held = rows.join(tasks.select(*keys, "request_start", "request_end"), keys, "left").withColumn("_t", F.try_to_timestamp("date", form))
    day, start, end = F.to_date("_t"), F.col("request_start"), F.col("request_end")
    fault = F.when(start.isNull() | ~F.col("units").eqNullSafe(F.lit("INCHES")), "identity").when(day.isNull() | ~day.between(F.date_sub(start, 2), F.date_add(end, 2)), "outside")
    number = F.col("value").try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))
    inches = F.when(finite & (number != ABSENT), number)
    status = F.when(~finite | number.isNull(), "missing_or_nonnumeric").when(number == ABSENT, "missing_sentinel_-9999").when(number < 0, "negative_swe").otherwise("numeric")
    utc = lambda t: t + F.expr(PACIFIC)
    record = F.struct(
        utc(F.try_to_timestamp("obs_date", form)).alias("observed_utc"), F.col("value").alias("raw_value"), inches.alias("value_inches"), (inches * INCH).alias("swe_mm"),
        F.col("data_flag").alias("data_flag"), status.alias("value_status"), F.col("date").alias("provider_date"),
    )
    kept = held.withColumn("fault", fault).where(F.col("fault").isNotNull() | day.between(start, end))
    found = kept.groupBy(*keys, utc(F.col("_t")).alias("stamp_utc"), "fault").agg(F.min(record).alias("r"), F.max(record).alias("_last"))
    return found.select(*keys, "stamp_utc", "r.*", F.coalesce("fault", F.when(~F.col("r").eqNullSafe(F.col("_last")), "conflict")).alias("fault"))


# Sensor, duration, units and SI factor of the natural-flow products, their marks of a missing value, and cubic metres in a cubic foot.
FLOWS = {"daily": (8, "D", "CFS", 0.028316846592, "m3 s-1"), "monthly": (65, "M", "AF", 1233.48183754752, "m3")}
ABSENT_MARKS = ("", "M", "---", "NAN", "NULL")
CUBIC_FOOT = 0.028316846592
# Qualifiers that withdraw a daily discharge.
WITHDRAWN = ("INVALID", "MISSING", "REJECTED")


def _finite(text: Column) -> Column:
    """The finite number that a text reads, else null; a type suffix as in ``1d`` is no number."""
    number = F.when(~text.rlike(r"[dDfF]\s*$"), text.try_cast("double"))
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def natural_flow(rows: DataFrame, tasks: DataFrame) -> DataFrame:
    """Natural-flow records of the requests they answer: a row per series and stamp, in UTC and SI units.

    ``rows``: station_id, sensor_number, duration_code, units, date, obs_date, value, data_flag (as given). ``tasks``: station_id,
    resolution (a key of FLOWS), request_start, request_end; repeated ones count once. ``value_status``: ``missing`` (null or a
    mark), ``missing_sentinel_-9999``, ``nonnumeric``, ``negative``, ``numeric``. ``fault``: ``identity`` (no such request, or other
    units), ``outside`` (of the request, or no date), ``conflict`` (records of one stamp differ; the least is shown, equal ones are one).
    Rows without station are ``identity``; empty input gives no rows.
    """
    keys = ["station_id", "sensor_number", "duration_code"]
    form = F.lit("yyyy-MM-dd HH:mm")
    product = F.array(*(F.struct(F.lit(r).alias("resolution"), F.lit(s).alias("sensor_number"), F.lit(d).alias("duration_code"), F.lit(u).alias("_units"), F.lit(f).alias("_factor"), F.lit(si).alias("units_si")) for r, (s, d, u, f, si) in FLOWS.items()))
    asked = tasks.select("station_id", F.explode(F.filter(product, lambda p: p["resolution"] == F.col("resolution"))).alias("_p"), "request_start", "request_end").select("station_id", "_p.*", "request_start", "request_end").distinct()
    held = rows.join(asked, keys, "left").withColumn("_t", F.try_to_timestamp("date", form))
    day = F.to_date("_t")
    fault = F.when(F.col("_units").isNull() | ~F.col("units").eqNullSafe(F.col("_units")), "identity").when(~F.coalesce(day.between(F.col("request_start"), F.col("request_end")), F.lit(False)), "outside")
    raw, number = F.col("value"), _finite(F.col("value"))
    value = F.when(number != ABSENT, number)
    status = F.when(F.coalesce(F.upper(F.trim(raw)).isin(*ABSENT_MARKS), F.lit(True)), "missing").when(number.isNull(), "nonnumeric").when(number == ABSENT, "missing_sentinel_-9999").when(number < 0, "negative").otherwise("numeric")
    utc = lambda t: t + F.expr(PACIFIC)
    record = F.struct(
        utc(F.try_to_timestamp("obs_date", form)).alias("observed_utc"), raw.alias("raw_value"), value.alias("value"), (value * F.col("_factor")).alias("value_si"), F.col("units_si").alias("units_si"),
        F.col("data_flag").alias("data_flag"), status.alias("value_status"), F.date_format("_t", "yyyy-MM-dd").alias("_day"),
    )
    found = held.withColumn("fault", fault).groupBy(*keys, "resolution", utc(F.col("_t")).alias("stamp_utc"), "fault").agg(F.min(record).alias("r"), F.max(record).alias("_last"))
    label = F.when(F.col("duration_code") == "M", F.substring("r._day", 1, 7)).otherwise(F.col("r._day"))
    return found.select(*keys, "resolution", "stamp_utc", "r.*", label.alias("period_label"), F.coalesce("fault", F.when(~F.col("r").eqNullSafe(F.col("_last")), "conflict")).alias("fault")).drop("_day")


#: What is read of a page of daily values; values and qualifiers stay text, as both come as text, number or list.
PAGE = """type string, numberReturned long, features array<struct<id: string, properties: struct<monitoring_location_id: string, time_series_id: string,
parameter_code: string, statistic_id: string, time: string, value: string, unit_of_measure: string, approval_status: string, qualifier: string, last_modified: string>>>"""


def paged_features(pages: DataFrame, page: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Features of pages of JSON, one row each, and the faults that forbid their use.

    Faults (page, id, fault): ``invalid`` (no collection of features), ``count`` (of another number than the page says), ``missing_id``,
    and ``repeated_id`` (within a page or over several; page is null). Without faults every feature came once.
    """
    read = pages.select(F.col(page).alias("page"), F.from_json(text, PAGE).alias("_j"))
    n = F.size("_j.features")
    invalid = ~F.coalesce(F.col("_j.type") == "FeatureCollection", F.lit(False)) | F.col("_j.features").isNull()
    of_page = F.when(invalid, "invalid").when(F.coalesce(F.col("_j.numberReturned"), n) != n, "count")
    features = read.select("page", F.explode("_j.features").alias("_f")).select("page", "_f.id", "_f.properties.*")
    # pages are read once: what a page and its features have to say is counted together, ids over all pages
    kind, none = "array<struct<page: " + features.schema["page"].dataType.simpleString() + ", id: string, fault: string>>", F.lit(None)
    said = F.transform("_j.features", lambda f: F.when(F.coalesce(f["id"] == "", F.lit(True)), F.struct(F.col("page").alias("page"), f["id"].alias("id"), F.lit("missing_id").alias("fault"))).otherwise(F.struct(none.cast(features.schema["page"].dataType).alias("page"), f["id"].alias("id"), none.cast("string").alias("fault"))))
    own = F.when(of_page.isNotNull(), F.array(F.struct(F.col("page").alias("page"), none.cast("string").alias("id"), of_page.alias("fault"))))
    each = read.select(F.explode(F.concat(*(F.coalesce(x.cast(kind), F.array().cast(kind)) for x in (own, said)))).alias("_s")).select("_s.*")
    counted = each.groupBy("page", "id", "fault").agg(F.count("*").alias("_n")).where("fault is not null or _n > 1")
    times = F.when(F.col("fault").isNull(), F.lit(1).cast("long")).otherwise(F.col("_n"))
    faults = counted.select("page", "id", F.coalesce("fault", F.lit("repeated_id")).alias("fault"), F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("_k")).drop("_k")
    return features, faults


def daily_discharge(features: DataFrame, series: DataFrame, start: Column, stop: Column) -> DataFrame:
    """Daily discharge as asked: a row per series and day, in cubic feet and metres a second. The day is a label, not an instant.

    ``features`` as of ``paged_features``, ``series``: monitoring_location_id, time_series_id. ``value_status``: ``missing_or_nonnumeric``,
    ``explicit_invalid_qualifier``, ``numeric_negative``, ``numeric``. ``fault``: ``identity`` (unknown series, or another parameter, statistic or
    unit), ``outside`` (of start to stop, or no date), ``repeated`` (several rows of a series and day; the least is shown). ``rows`` counts them.
    """
    keys = ["monitoring_location_id", "time_series_id"]
    known = series.select(*keys).distinct().withColumn("_known", F.lit(True))
    # Codes of discharge and of the daily mean, and its unit.
    asked = F.col("parameter_code").eqNullSafe(F.lit("00060")) & F.col("statistic_id").eqNullSafe(F.lit("00003")) & F.col("unit_of_measure").eqNullSafe(F.lit("ft^3/s"))
    day = F.try_to_timestamp("time", F.lit("yyyy-MM-dd")).cast("date")
    fault = F.when(F.col("_known").isNull() | ~asked, "identity").when(~F.coalesce(day.between(start, stop), F.lit(False)), "outside")
    flags = F.coalesce(F.from_json("qualifier", "array<string>"), F.array("qualifier"))
    withdrawn = F.exists(flags, lambda f: F.coalesce(F.upper(f).isin(*WITHDRAWN), F.lit(False)))
    number = _finite(F.col("value"))
    status = F.when(number.isNull(), "missing_or_nonnumeric").when(withdrawn, "explicit_invalid_qualifier").when(number < 0, "numeric_negative").otherwise("numeric")
    cfs = F.when(~withdrawn, number)
    record = F.struct(F.col("id").alias("observation_id"), F.col("value").alias("raw_value"), cfs.alias("discharge_cfs"), (cfs * CUBIC_FOOT).alias("discharge_m3_s"), "approval_status", "qualifier", "last_modified", status.alias("value_status"))
    judged = features.join(known, keys, "left").withColumn("fault", fault)
    found = judged.groupBy(*keys, day.alias("day"), "fault").agg(F.min(record).alias("r"), F.count("*").alias("rows"))
    return found.select(*keys, "day", "r.*", "rows", F.coalesce("fault", F.when(F.col("rows") > 1, "repeated")).alias("fault"))


def flow_series(stations: DataFrame, products: list[tuple[str, int, str, str]], optional: list[tuple[str, str]] = ()) -> DataFrame:
    """Per station and product (resolution, sensor, duration, units) the one sensor that gives it and when that starts.

    ``stations``: station_id, sensors (an array of sensor_number, duration_code, units, advertised_availability).
    ``fault``: ``missing`` (unless (station, resolution) is optional, which gives no row), ``repeated``, ``units``.
    """
    wanted = F.array(*(F.struct(F.lit(r).alias("resolution"), F.lit(s).alias("sensor_number"), F.lit(d).alias("duration_code"), F.lit(u).alias("units")) for r, s, d, u in products))
    each = stations.withColumn("p", F.explode(wanted))
    fits = each.withColumn("_s", F.filter("sensors", lambda s: (s["sensor_number"] == F.col("p.sensor_number")) & (s["duration_code"] == F.col("p.duration_code"))))
    n, first = F.coalesce(F.size("_s"), F.lit(0)), F.col("_s").getItem(0)
    spare = F.lit(False)
    for station, resolution in optional:
        spare = spare | ((F.col("station_id") == station) & (F.col("p.resolution") == resolution))
    fault = F.when(n < 1, "missing").when(n > 1, "repeated").when(~first["units"].eqNullSafe(F.col("p.units")), "units")
    start = F.when(n == 1, F.try_to_timestamp(F.split(first["advertised_availability"], " to ").getItem(0), F.lit("MM/dd/yyyy")).cast("date"))
    return fits.where(~(spare & (n < 1))).select("station_id", "p.resolution", "p.sensor_number", "p.duration_code", start.alias("start"), fault.alias("fault"))


def snow_series(stations: DataFrame, sensors: list[int], durations: dict[str, str], floor: date = date(1800, 1, 1)) -> DataFrame:
    """Each snow series that a station's sensors advertise, when it starts and, where it has ended, when.

    ``fault``: ``unknown`` (duration or units), ``repeated`` (series key), ``availability`` (no "from to").
    """
    snow_only = F.filter("sensors", lambda s: s["sensor_number"].isin(sensors))
    each = stations.select("station_id", snow_only.alias("sensors")).withColumn("s", F.explode("sensors"))
    same = F.size(F.filter("sensors", lambda s: (s["sensor_number"] == F.col("s.sensor_number")) & (s["duration_code"] == F.col("s.duration_code"))))
    said = F.split("s.advertised_availability", "to ", 2)
    day = lambda c: F.try_to_timestamp(F.trim(c), F.lit("MM/dd/yyyy")).cast("date")
    begin, finish = F.trim(said.getItem(0)), F.get(said, F.lit(1))
    resolution = F.create_map(*(F.lit(x) for pair in durations.items() for x in pair))[F.col("s.duration_code")]
    fault = F.when(resolution.isNull() | ~F.col("s.units").eqNullSafe(F.lit("INCHES")), "unknown").when(same > 1, "repeated").when(finish.isNull(), "availability")
    return each.select(
        "station_id", "s.sensor_number", "s.duration_code", resolution.alias("resolution"), F.when(begin == "", F.lit(floor)).otherwise(day(begin)).alias("start"),
        F.when(finish != "present", day(finish)).alias("advertised_end"), F.when(begin == "", "request_floor").otherwise("provider").alias("start_source"), fault.alias("fault"),
    )


def discharge_inventory(combined: DataFrame, daily: DataFrame, states: list[str]) -> DataFrame:
    """A verdict for each series id of two lists that must hold the same: why it is wrong or excluded, or ``kept``.

    ``combined``: id, station, parameter, statistic, data_type, agency, country, state. ``daily``: id, station, parameter, statistic, period.
    """
    left = combined.groupBy("id").agg(F.count("*").alias("_nl"), F.max(F.struct("station", "parameter", "statistic", "data_type", "agency", "country", "state")).alias("l"))
    right = daily.groupBy("id").agg(F.count("*").alias("_nr"), F.max(F.struct("station", "parameter", "statistic", "period")).alias("r"))
    # Codes of discharge and of the daily mean.
    asked = lambda s: s["parameter"].eqNullSafe(F.lit("00060")) & s["statistic"].eqNullSafe(F.lit("00003"))
    a, b = F.col("l"), F.col("r")
    same = a["data_type"].eqNullSafe(F.lit("Daily values")) & b["period"].eqNullSafe(F.lit("Daily")) & (a["station"] == b["station"])
    verdict = (
        F.when(b.isNull(), "combined_only").when(a.isNull(), "daily_only").when((F.col("_nl") > 1) | (F.col("_nr") > 1), "repeated")
        .when(~(asked(a) & asked(b)), "filter_ignored").when(~F.coalesce(same, F.lit(False)), "mismatch")
        .when(~a["agency"].eqNullSafe(F.lit("USGS")) | ~a["station"].startswith("USGS-"), "other_agency")
        .when(~a["country"].eqNullSafe(F.lit("US")) | ~F.coalesce(a["state"].isin(states), F.lit(False)), "outside").otherwise("kept")
    )
    return left.join(right, "id", "full_outer").select("id", F.coalesce(a["station"], b["station"]).alias("station"), verdict.alias("verdict"))


def gauge_stations(series: DataFrame, zones: DataFrame) -> DataFrame:
    """A row per station of series rows (station, zone, longitude, latitude): its point, zone and issues.

    ``zones`` (zone, offset). ``conflict`` marks stations whose series say different things of them.
    """
    lon, lat = F.col("longitude"), F.col("latitude")
    point = F.coalesce(lon.between(-180, 180) & lat.between(-90, 90) & ~F.isnan(lon) & ~F.isnan(lat), F.lit(False))
    said = F.struct("zone", F.when(point, lon).alias("longitude"), F.when(point, lat).alias("latitude"))
    each = series.groupBy("station").agg(F.min(said).alias("s"), F.max(said).alias("_last"))
    known = zones.select("zone", "offset").dropDuplicates(["zone"])
    out = each.select("station", "s.*", (~F.col("s").eqNullSafe(F.col("_last"))).alias("conflict")).join(known, "zone", "left")
    return out.withColumns({"coordinate_issue": F.col("longitude").isNull(), "time_zone_issue": F.col("offset").isNull()})


def climate_station_hours(lines: DataFrame, text: str = "value") -> DataFrame:
    """Hourly lines of 38 fields apart by white space: station, stamp, point, K, fraction of humidity and W/m2.

    Values at or below -9000 are missing, and so are humidity and radiation of another flag than 0. ``fault``
    is ``columns`` for a line that has not 38 fields, whose values are null.
    """
    f = lambda k: F.get("_f", F.lit(k))
    whole = F.coalesce(F.size("_f") == 38, F.lit(False))
    number = lambda k: F.when(whole & (f(k).try_cast("double") > -9000), f(k).try_cast("double"))
    clear = lambda k, flag: F.when(f(flag).try_cast("double") == 0, number(k))
    stamp = F.try_to_timestamp(F.concat(f(1), F.lpad(f(2), 4, "0")), F.lit("yyyyMMddHHmm"))
    return lines.withColumn("_f", F.split(F.trim(F.regexp_replace(F.col(text), r"\s+", " ")), " ")).withColumns({
        "station": F.when(whole, f(0)), "stamp": F.when(whole, stamp), "longitude": F.when(whole, f(6).try_cast("double")), "latitude": F.when(whole, f(7).try_cast("double")),
        "temperature_k": number(9) + KELVIN, "shortwave": clear(13, 14), "relative_humidity": clear(26, 27) / 100, "fault": F.when(~whole, "columns"),
    }).drop("_f")


def granules(entries: DataFrame, day: Column, prefix: str, suffix: str, collection: str, host: str) -> DataFrame:
    """Entries of a listing with the hour their name gives, their one data address, and their fault.

    ``entries``: id, collection, name, time_start, links (an array of href, rel, inherited). Names read
    ``prefix`` YYYYMMDD.HH00 ``suffix``. ``fault``: ``repeated_id``, ``collection``, ``name``, ``time``, ``address`` (none or several), ``repeated_name``.
    """
    hour = F.regexp_extract("name", r"\.([0-9]{2})00" + suffix.replace(".", r"\.") + "$", 1).try_cast("int")
    stem = F.concat(F.lit(prefix), F.date_format(day, "yyyyMMdd"), F.lit("."), F.lpad(hour.cast("string"), 2, "0"), F.lit("00"), F.lit(suffix))
    named = F.coalesce((F.col("name") == stem) & (hour <= 23), F.lit(False))
    ours = lambda x: ~F.coalesce(x["inherited"], F.lit(False)) & x["rel"].endswith("/data#") & x["href"].startswith(f"https://{host}/") & (F.substring_index(F.substring_index(x["href"], "?", 1), "/", -1) == F.col("name"))
    urls = F.array_distinct(F.transform(F.filter("links", ours), lambda x: x["href"]))
    n = F.coalesce(F.size(urls), F.lit(0))
    due = day.cast("timestamp") + F.make_interval(hours=hour)
    times = lambda c: F.count("*").over(Window.partitionBy(c))
    fault = (
        F.when(times("id") > 1, "repeated_id").when(~F.col("collection").eqNullSafe(F.lit(collection)), "collection").when(~named, "name")
        .when(~F.col("time_start").eqNullSafe(due), "time").when(n != 1, "address").when(times("name") > 1, "repeated_name")
    )
    return entries.select("id", "name", F.when(named, hour).alias("hour"), F.when(n == 1, urls.getItem(0)).alias("address"), fault.alias("fault"))


def hourly_leads(records: DataFrame, by: list[str], start: str, lead: str, value: str, average: bool, most_negative: float) -> DataFrame:
    """The last hour of statistics gathered since a lead, a row per by (cycle, variable, cell), start and lead in hours; ``same`` counts the records of a lead.

    A record of one hour is that hour; a longer one (an average, or a sum) needs the record of the same start and the lead right before. ``hour_value`` is never negative:
    less is set to 0 (``clipped``) unless it is below -``most_negative``. ``fault``: ``interval`` (no hour at all), ``repeated`` (several records of a lead), ``no_previous``, ``missing`` (a null or NaN
    value), ``negative``; the value is null then. The windows, over the few leads of one key and start, get a row per lead; records are dealt out once, as the windows need them.
    """
    number = F.col(value).cast("double")
    # of several records of a lead the value is never used
    leads = records.repartition(*by, start).groupBy(*by, start, lead).agg(F.count("*").alias("same"), F.max(F.when(~F.isnan(number), number)).alias("_v"))
    w = Window.partitionBy(*by, start).orderBy(lead)
    each = leads.withColumns({"_n": F.col(lead) - F.col(start), "_before": F.lag(lead).over(w), "_was": F.lag("_v").over(w), "_times": F.lag("same").over(w)})
    total, earlier = (F.col("_v") * F.col("_n"), F.col("_was") * (F.col("_n") - 1)) if average else (F.col("_v"), F.col("_was"))
    alone = F.col("_n") == 1
    hour = F.when(alone, F.col("_v")).otherwise(total - earlier)
    adjacent = F.coalesce(F.col("_before") == F.col(lead) - 1, F.lit(False))
    fault = (
        F.when(~F.coalesce(F.col("_n") > 0, F.lit(False)), "interval").when(F.col("same") > 1, "repeated").when(~alone & ~adjacent, "no_previous").when(~alone & (F.col("_times") > 1), "repeated")
        .when(hour.isNull(), "missing").when(hour < -most_negative, "negative")
    )
    out = each.withColumns({"fault": fault, "_hour": hour})
    sound = F.col("fault").isNull()
    return out.withColumns({"hour_value": F.when(sound, F.greatest("_hour", F.lit(0.0))), "clipped": sound & (F.col("_hour") < 0)}).select(*by, start, lead, "same", "fault", "hour_value", "clipped")


def hourly_statistic(records: DataFrame, by: list[str], start: str, lead: str, value: str, average: bool, most_negative: float) -> DataFrame:
    """``records``, each with the ``fault``, ``hour_value`` and ``clipped`` of its lead, as of ``hourly_leads``."""
    keys = [*by, start, lead]
    found = hourly_leads(records, by, start, lead, value, average, most_negative).drop("same").withColumnsRenamed({k: f"_of_{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{i}"))
    return records.join(found, same).drop(*(f"_of_{i}" for i in range(len(keys))))
