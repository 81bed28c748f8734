"""Landed price/market payloads: read, parse to ticks and assets, quarantine.

A poll lands as one row ``(payload STRING, ingested_at TIMESTAMP)``; files of
such rows (JSON lines, Parquet) arrive in a folder or from a bus. Parsing is
pure Column work: ``from_json`` to ``map<string, map<string, string>>``,
``explode`` to one row per asset, ``try_cast`` per number. Parsing numbers as
strings first means one malformed value loses only its own asset (it goes to
quarantine); a typed map would null the whole payload.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import MARKET_PAYLOAD, PAYLOAD, PRICE_PAYLOAD, TICK_COLUMNS


# Landed JSON carries the poll time as ISO-8601 with microseconds.
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_payloads(spark: SparkSession, path: str, streaming: bool = False, fmt: str = "json",
                  max_files_per_trigger: int | None = None,
                  options: dict[str, str] | None = None, sequence: str | None = None) -> DataFrame:
    """Landed polls as ``(payload, ingested_at)``, batch or streaming.
    ``sequence`` names a column for the place in landing order: file time,
    file and block (rows of one block are in landing order already)."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(PAYLOAD).format(fmt)
    if fmt == "json":
        reader = reader.option("timestampFormat", JSON_TS_FORMAT)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    polls = reader.load(path)
    if sequence is None:
        return polls
    return polls.select("*", F.struct(
        F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block")).alias(sequence))


def from_bus(records: DataFrame, value: str = "value", time: str = "timestamp") -> DataFrame:
    """A1 from a message bus: Kafka-shaped records (``value`` bytes, broker
    ``timestamp``) as landed polls ``(payload, ingested_at)``. Works on the
    batch or streaming DataFrame of ``spark.readStream.format("kafka")`` when
    the connector is on the classpath; nothing here depends on it."""
    return records.select(F.col(value).cast("string").alias("payload"),
                          F.col(time).cast("timestamp").alias("ingested_at"))


def _exploded(payloads: DataFrame, vs: str = "usd", strict: bool = False,
              keep: Sequence[str] = ()) -> DataFrame:
    m = F.from_json(F.col("payload"), PRICE_PAYLOAD)
    if strict:
        # drop the whole poll when any of its assets holds a malformed number
        m = F.when(~F.exists(F.map_values(m), lambda f: _malformed(f, vs)), m)
    return payloads.select(F.col("ingested_at"), *keep, F.explode(m).alias("asset_id", "_f"))


def _typed(df: DataFrame, vs: str, keep: Sequence[str] = ()) -> DataFrame:
    f = F.col("_f")
    price_raw = f.getItem(vs)
    last = f.getItem("last_updated_at")
    return df.select(
        "asset_id",
        F.coalesce(F.timestamp_seconds(last.try_cast("double")), F.col("ingested_at")).alias("ts"),
        "ingested_at",
        price_raw.try_cast("double").alias("price"),
        f.getItem(f"{vs}_24h_vol").try_cast("double").alias("volume_24h"),
        f.getItem(f"{vs}_market_cap").try_cast("double").alias("market_cap"),
        f.getItem(f"{vs}_24h_change").try_cast("double").alias("change_24h"),
        *keep,
        price_raw.alias("_price_raw"),
        _malformed(f, vs).alias("_bad"),
    )


def _malformed(f: Column, vs: str) -> Column:
    """A present, non-null number field that does not parse or is not a number (NaN)."""
    checks = []
    for key in (vs, f"{vs}_24h_vol", f"{vs}_market_cap", f"{vs}_24h_change", "last_updated_at"):
        v = f.getItem(key)
        number = v.try_cast("double")
        checks.append(v.isNotNull() & (number.isNull() | F.isnan(number)))
    out = checks[0]
    for c in checks[1:]:
        out = out | c
    return out


def parse_prices(payloads: DataFrame, vs: str = "usd", strict: bool = False,
                 keep: Sequence[str] = ()) -> DataFrame:
    """One tick per priced asset of each poll.

    * an asset without a ``vs`` price (missing key or JSON null) is skipped;
      price 0 is kept;
    * ``ts`` = ``last_updated_at`` (epoch seconds) or else ``ingested_at``;
    * optional numbers stay null when absent;
    * an asset with a malformed number (NaN too) and a poll without a poll time,
      which is part of a tick's key, give no tick (see :func:`price_rejects`);
      ``strict=True`` drops every asset of a poll holding one (the sequential
      client loses the whole poll in that case).

    ``keep`` names payload columns carried to every tick (e.g. landing time).
    """
    typed = _typed(_exploded(payloads, vs, strict, keep), vs, keep)
    whole = F.col("price").isNotNull() & F.col("ingested_at").isNotNull() & ~F.col("_bad")
    return typed.where(whole).select(*TICK_COLUMNS, *keep)


def unpriced(payloads: DataFrame, vs: str = "usd") -> DataFrame:
    """B1 complement: ``(asset_id, ingested_at)`` of assets skipped for lacking a price."""
    typed = _typed(_exploded(payloads), vs)
    return typed.where(F.col("_price_raw").isNull()).select("asset_id", "ingested_at")


def price_rejects(payloads: DataFrame, vs: str = "usd") -> DataFrame:
    """Quarantine of the price feed: unreadable payloads, assets with a
    malformed number and priced assets of a poll without a poll time, with a
    reason. One parse: ``explode_outer`` keeps a row for a payload that did
    not parse, so all kinds come from one pass."""
    parsed = payloads.select("ingested_at", "payload",
                             F.from_json(F.col("payload"), PRICE_PAYLOAD).alias("_m"))
    rows = parsed.select("ingested_at", "payload", F.col("_m").isNull().alias("_unread"),
                         F.explode_outer("_m").alias("asset_id", "_f"))
    unreadable = F.col("payload").isNotNull() & F.col("_unread")
    bad = F.col("_f").isNotNull() & _malformed(F.col("_f"), vs)
    untimed = F.col("ingested_at").isNull() & F.col("_f").getItem(vs).isNotNull()
    return rows.where(unreadable | bad | untimed).select(
        "asset_id", "ingested_at",
        F.when(F.col("_f").isNotNull(), F.to_json("_f")).otherwise(F.col("payload")).alias("payload"),
        F.when(bad, F.lit("malformed number")).when(untimed, F.lit("missing poll time"))
         .otherwise(F.lit("unreadable payload")).alias("reason"))


def parse_markets(payloads: DataFrame, now=None, position: str | None = None) -> DataFrame:
    """A3: market payload (JSON array) to asset rows; rows lacking ``id``,
    ``symbol`` or ``name`` are left out (see :func:`market_rejects`).
    ``created_at``/``updated_at`` are set to ``now`` (or the poll time);
    ``position`` names a column for a row's place in its payload."""
    rows = _market_rows(payloads)
    stamp = F.lit(now).cast("timestamp") if now is not None else F.col("ingested_at")
    ok = F.col("m.id").isNotNull() & F.col("m.symbol").isNotNull() & F.col("m.name").isNotNull()
    place = [F.col("_pos").alias(position)] if position else []
    return rows.where(ok).select(
        F.col("m.id").alias("id"), F.col("m.symbol").alias("symbol"), F.col("m.name").alias("name"),
        F.col("m.image").alias("image_url"), F.col("m.max_supply").try_cast("double").alias("max_supply"),
        stamp.alias("created_at"), stamp.alias("updated_at"), *place)


def market_rejects(payloads: DataFrame) -> DataFrame:
    """What :func:`parse_markets` leaves out or blanks: rows without a required
    field, a ``max_supply`` that is no number, and payloads that can't be read
    (``row`` then holds the payload)."""
    rows = _market_rows(payloads)
    supply = F.col("m.max_supply")
    reasons = F.array_compact(F.array(
        F.when(F.col("m").isNull(), F.lit("unreadable payload")),
        *[F.when(F.col("m").isNotNull() & F.col(f"m.{k}").isNull(), F.lit(f"missing {k}"))
          for k in ("id", "symbol", "name")],
        F.when(supply.isNotNull() & supply.try_cast("double").isNull(), F.lit("malformed max_supply"))))
    return (rows.select("ingested_at", F.coalesce(F.to_json("m"), F.col("payload")).alias("row"),
                        reasons.alias("reasons"))
                .where(F.size("reasons") > 0))


def _market_rows(payloads: DataFrame) -> DataFrame:
    """One row per array entry with its place; unreadable payloads and null
    entries give a null entry, an empty array gives nothing."""
    parsed = F.from_json(F.col("payload"), MARKET_PAYLOAD)
    return (payloads.select("ingested_at", "payload", parsed.alias("_a"))
            .where(F.col("_a").isNull() | (F.size("_a") > 0))
            .select("ingested_at", "payload", F.posexplode_outer("_a").alias("_pos", "m")))


def conform(bronze: DataFrame, vs: str = "usd", order: Sequence[str] = ("landed_at",),
            key: Sequence[str] = ("asset_id", "ingested_at")) -> tuple[DataFrame, DataFrame]:
    """L2 silver conform of landed price polls: parse and type (A2, B1-B3),
    deduplicate on the tick key with the first landing winning (C3), and
    quarantine what cannot be read. Returns ``(ticks, rejects)``."""
    from tidemark.operators.keyed import first_per_key

    keep = [c for c in order if c in bronze.columns]
    typed = parse_prices(bronze, vs=vs, keep=keep)
    good = first_per_key(typed, list(key), list(order) if keep else ["ingested_at"])
    return good.select(*TICK_COLUMNS), price_rejects(bronze.select("payload", "ingested_at"), vs)


# ---------------------------------------------------------------------------
# Bronze landing and the contract check
# ---------------------------------------------------------------------------
def write_landed(payloads: DataFrame, path: str, fmt: str = "json") -> None:
    """Land polls as files (JSON lines by default) for :func:`read_payloads`."""
    w = payloads.write.mode("append").format(fmt)
    if fmt == "json":
        w = w.option("timestampFormat", JSON_TS_FORMAT)
    w.save(path)


def land_bronze(df: DataFrame, source: str, now=None) -> DataFrame:
    """L1: raw rows as landed, tagged with source, landing time and date
    (the partition column). Nothing is changed or dropped."""
    stamp = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    return (df.withColumn("source", F.lit(source))
              .withColumn("landed_at", stamp)
              .withColumn("ingest_date", F.to_date(stamp)))


def write_bronze(df: DataFrame, path: str) -> None:
    """Append to a date-partitioned Parquet table (history is never rewritten)."""
    df.write.mode("append").partitionBy("ingest_date").parquet(path)


def contract(df: DataFrame, schema: T.StructType, column: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Parse JSON records against a versioned schema. Records that do not
    conform (unreadable, a field of the wrong type, or a required field missing
    or null) are rejected at the edge.

    Returns ``(good, rejects)``: ``good`` has the schema's fields plus the
    other input columns; ``rejects`` keeps the raw record and a reason.
    """
    corrupt = "_corrupt_record"
    loose = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    with_corrupt = T.StructType(loose + [T.StructField(corrupt, T.StringType(), True)])
    parsed_col = F.from_json(F.col(column), with_corrupt,
                             {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    # a one-element explode is a Generate: filters on its output cannot be
    # pushed below it, so the record is parsed once, not once per reference
    parsed = df.select("*", F.explode(F.array(parsed_col)).alias("_p"))
    missing = F.lit(False)
    for f in schema.fields:
        if not f.nullable:
            missing = missing | F.col(f"_p.{f.name}").isNull()
    unread = F.col(column).isNull() | F.col("_p").isNull() | F.col(f"_p.{corrupt}").isNotNull()
    bad = unread | missing
    others = [c for c in df.columns if c != column]
    good = parsed.where(~bad).select(*others, *[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields])
    rejects = parsed.where(bad).select(*others, F.col(column), F.when(unread, F.lit("does not match contract"))
                                       .otherwise(F.lit("missing required field")).alias("reason"))
    return good, rejects


def schema_changes(old: T.StructType, new: T.StructType) -> list[str]:
    """L9 compatibility: a new nullable field is fine; a removed field, a
    changed type, a new required field, or a change of nullability breaks the
    contract."""
    problems = []
    new_fields = {f.name: f for f in new.fields}
    for f in old.fields:
        g = new_fields.get(f.name)
        if g is None:
            problems.append(f"removed {f.name}")
        elif g.dataType != f.dataType:
            problems.append(f"retyped {f.name}: {f.dataType.simpleString()} -> {g.dataType.simpleString()}")
        elif f.nullable is False and g.nullable:
            problems.append(f"{f.name} became nullable")
        elif f.nullable and not g.nullable:
            problems.append(f"{f.name} became required")
    old_names = {f.name for f in old.fields}
    for g in new.fields:
        if g.name not in old_names and not g.nullable:
            problems.append(f"added required {g.name}")
    return problems
