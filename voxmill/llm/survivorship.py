"""Golden records: one record for each cluster of client records, every field from the record that it trusts most.

1. Rows are written once with a salt, so that a cluster of any size lies in as many pieces as there are shuffle partitions.
2. In each piece windows find the latest time and, by row_number, the first segment; a window over the pieces of a
   cluster (one row each) makes them the cluster's latest time and chosen segment.
3. These go back to the rows of the pieces.  Now staleness and membership of the chosen segment are known, and one row_number window
   for each field, in that field's own order, ranks the rows of a piece; conditional aggregation keeps the winners.
4. The same windows over the winners of a cluster's pieces, and the same aggregation, collapse them into the golden record.

No order depends on other rows once the latest time and the segment are known, so a cluster's winner is the first of its
pieces' winners.  Nothing is broadcast or collected.

Edge cases: rows without master_id stand under their client_id, those without both in one cluster of null; blank strings are null, as are balances
that aren't finite; unknown sources are trusted least; where all times are null every record is stale; exactly repeated rows
are records of their own, and records alike in all that orders them are taken by the smaller value; values of any length are
compared whole; an empty table gives no record; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import durable, shuffle_width, table

#: Sources by falling trust.
TRUST = ("crm", "web", "store", "partner")
STALE_HOURS = 60 * 24
PIECE = ["cluster_id", "_salt"]
#: Fields that only fresh and trusted records should give, before the others.
TRUSTED = ("name", "email")
FIELDS = ("name", "email", "segment", "balance", "address")


def solid(column: str) -> Column:
    """A string that holds more than white space."""
    return F.when(F.col(column).rlike(r"[^\x20\x09-\x0D]"), F.col(column))


def prepared(clients: DataFrame) -> DataFrame:
    trust = F.coalesce(*[F.when(solid("source") == s, len(TRUST) - i) for i, s in enumerate(TRUST)], F.lit(0))
    balance = F.col("balance").cast("double")
    number = F.when(~F.isnan(balance) & (F.abs(balance) < float("inf")), balance)
    client = F.col("client_id").cast("long")
    rows = clients.select(
        F.coalesce(F.col("master_id").cast("long"), client).alias("cluster_id"), client.alias("client"), trust.alias("trust"), F.col("updated_at").cast("timestamp_ntz").alias("at"),
        solid("name").alias("name"), solid("email").alias("email"), solid("city").alias("city"), F.col("nation_id").cast("int").alias("nation_id"), solid("segment").alias("segment"), number.alias("balance"),
    )
    return rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(shuffle_width(clients.sparkSession))).cast("int"))


def candidate(value: Column, first: Column, stale: Column) -> Column:
    """What a row offers for a field, and all that the field's order looks at; null where it has nothing to offer."""
    return F.when(value.isNotNull(), F.struct(first.cast("int").alias("first"), stale.alias("stale"), "trust", "at", "client", value.alias("value")))


def order(field: str) -> list[Column]:
    """Offers first, then the field's own measure, then fresh and trusted ones where the field asks for them, then the latest."""
    at = F.col(field)
    trusted = [at["stale"].asc(), at["trust"].desc()] if field in TRUSTED else []
    return [at.isNull().asc(), at["first"].desc(), *trusted, at["at"].desc_nulls_last(), at["trust"].desc(), at["client"].asc_nulls_last(), at["value"].asc_nulls_last()]


def winners(rows: DataFrame, key: list[str], fields: tuple[str, ...], **more: Column) -> DataFrame:
    """One row for each key: the first offer for every field, and further aggregates."""
    ranks = {f"_{f}": F.row_number().over(Window.partitionBy(*key).orderBy(*order(f))) for f in fields}
    firsts = [F.first(F.when(F.col(f"_{f}") == 1, F.col(f)), ignorenulls=True).alias(f) for f in fields]
    return rows.withColumns(ranks).groupBy(*key).agg(*firsts, *[c.alias(name) for name, c in more.items()])


def golden_records(clients: DataFrame, hours: int = STALE_HOURS) -> DataFrame:
    """clients -> (cluster_id, n_records, n_stale, name, email, segment, balance, address), the last five structs
    of value and client, null where no record has a value."""
    stored = durable(prepared(clients), "golden-rows")
    rows = stored.repartition(*PIECE)
    zero, no = F.lit(0), F.lit(False)

    # the latest time and the chosen segment, of pieces first and then of clusters
    offered = rows.withColumn("segment", candidate(F.col("segment"), zero, no))
    pieces = winners(offered, PIECE, ("segment",), latest=F.max("at"))
    whole = Window.partitionBy("cluster_id")
    ranked = pieces.withColumn("_k", F.row_number().over(whole.orderBy(*order("segment"))))
    chosen = F.max(F.when(F.col("_k") == 1, F.col("segment"))).over(whole)
    known = ranked.select("cluster_id", "_salt", F.max("latest").over(whole).alias("latest"), chosen.alias("chosen"))

    known = known.select(F.col("cluster_id").alias("_cluster"), F.col("_salt").alias("_piece"), "latest", "chosen")
    same = F.col("cluster_id").eqNullSafe(F.col("_cluster")) & (F.col("_salt") == F.col("_piece"))
    judged = rows.join(known.hint("merge"), same).drop("_cluster", "_piece")
    stale = F.coalesce(F.col("latest") - F.col("at") > F.make_dt_interval(F.lit(0), F.lit(hours)), F.lit(True))
    judged = judged.withColumn("_stale", stale)
    filled = F.col("city").isNotNull().cast("int") + F.col("nation_id").isNotNull().cast("int")
    inside = F.coalesce(F.col("segment") == F.col("chosen")["value"], no)
    at = F.col("_stale")
    offers = judged.select(
        *PIECE, "_stale", candidate(F.col("name"), F.char_length("name"), at).alias("name"), candidate(F.col("email"), zero, at).alias("email"), F.col("chosen").alias("segment"),
        candidate(F.col("balance"), inside, at).alias("balance"), candidate(F.struct("city", "nation_id"), filled, at).alias("address"),
    )
    ours = ("name", "email", "balance", "address")
    best = winners(offers, PIECE, ours, segment=F.first("segment"), n_records=F.count("*"), n_stale=F.count_if("_stale"))
    out = winners(best, ["cluster_id"], ours, segment=F.first("segment"), n_records=F.sum("n_records"), n_stale=F.sum("n_stale"))
    taken = [F.when(F.col(f).isNotNull(), F.struct(F.col(f)["value"].alias("value"), F.col(f)["client"].alias("client"))).alias(f) for f in FIELDS]
    return out.select("cluster_id", "n_records", "n_stale", *taken)


def op11_golden_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = golden_records(table(spark, sf_dir, "clients"))
    place = F.col("address")["value"]
    filled = place["city"].isNotNull() | place["nation_id"].isNotNull()
    plain = [F.col(f)["value"].alias(f) for f in ("name", "email", "segment")]
    sources = [F.col(f)["client"].alias(f"{f}_from") for f in ("name", "email", "segment", "balance")]
    cents = F.floor(100 * F.col("balance")["value"] + F.lit(0.5)).cast("long").alias("balance_cents")
    return records.select("cluster_id", "n_records", "n_stale", *plain, place["city"].alias("city"), place["nation_id"].alias("nation_id"), cents, *sources, F.when(filled, F.col("address")["client"]).alias("address_from"))


_RECENT = "updated_at DESC NULLS LAST, trust DESC, client_id NULLS LAST"
_TRUSTED = f"stale, trust DESC, {_RECENT}"
_SOLID = "CASE WHEN regexp_matches({0}, '[^\\x20\\x09-\\x0D]') THEN {0} END AS {0}"
SQL = f"""
WITH c AS (
  SELECT coalesce(master_id, client_id) AS cluster_id, client_id, updated_at, {", ".join(_SOLID.format(x) for x in ("name", "email", "city", "segment"))},
         nation_id, CASE WHEN isfinite(balance) THEN balance END AS balance,
         CASE source WHEN 'crm' THEN 4 WHEN 'web' THEN 3 WHEN 'store' THEN 2 WHEN 'partner' THEN 1 ELSE 0 END AS trust
  FROM clients
), s AS (
  SELECT *, coalesce(max(updated_at) OVER (PARTITION BY cluster_id) - updated_at > INTERVAL 1440 HOUR, true) AS stale,
         first_value(segment) OVER (PARTITION BY cluster_id ORDER BY segment IS NULL, {_RECENT}, segment) AS chosen
  FROM c
), r AS (
  SELECT *,
         row_number() OVER (PARTITION BY cluster_id ORDER BY segment IS NULL, {_RECENT}, segment) AS by_segment,
         row_number() OVER (PARTITION BY cluster_id ORDER BY email IS NULL, {_TRUSTED}, email) AS by_email,
         row_number() OVER (PARTITION BY cluster_id ORDER BY name IS NULL, length(name) DESC, {_TRUSTED}, name) AS by_name,
         row_number() OVER (PARTITION BY cluster_id ORDER BY balance IS NULL, coalesce(segment = chosen, false) DESC, {_RECENT}, balance) AS by_balance,
         row_number() OVER (PARTITION BY cluster_id ORDER BY (city IS NOT NULL)::INT + (nation_id IS NOT NULL)::INT DESC, {_RECENT}, city NULLS LAST, nation_id NULLS LAST) AS by_address
  FROM s
)
SELECT cluster_id, count(*) AS n_records, count(*) FILTER (WHERE stale) AS n_stale,
       max(name) FILTER (WHERE by_name = 1) AS name, max(email) FILTER (WHERE by_email = 1) AS email, max(segment) FILTER (WHERE by_segment = 1) AS segment,
       max(city) FILTER (WHERE by_address = 1) AS city, max(nation_id) FILTER (WHERE by_address = 1) AS nation_id,
       max(floor(100 * balance + 0.5)::BIGINT) FILTER (WHERE by_balance = 1) AS balance_cents,
       max(client_id) FILTER (WHERE by_name = 1 AND name IS NOT NULL) AS name_from, max(client_id) FILTER (WHERE by_email = 1 AND email IS NOT NULL) AS email_from,
       max(client_id) FILTER (WHERE by_segment = 1 AND segment IS NOT NULL) AS segment_from, max(client_id) FILTER (WHERE by_balance = 1 AND balance IS NOT NULL) AS balance_from,
       max(client_id) FILTER (WHERE by_address = 1 AND (city IS NOT NULL OR nation_id IS NOT NULL)) AS address_from
FROM r GROUP BY cluster_id
"""
