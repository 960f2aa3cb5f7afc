"""Mixing sources to target weights.

Words are summed per source (map-side partial sums), a share of the total is dealt to the
sources by weight, each target stops at a multiple of its source's size and the excess is
dealt again.  A source's repetition rate is target / size; each document is emitted
floor(rate) times plus one more copy if its hash-seeded draw falls below the fraction.

Sources are ranked by a distributed range sort, and the dealing loop only brings sums to the
driver, so neither the number of sources nor a hot source is a limit.

Defined cases: null text has no words; the null source is one source, ranked last; a source
without words has target 0 and no copies; the draw depends on id and seed only, so rows that
share an id share their draw and reruns agree; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, read_table, stored
from .registry import register

WEIGHTS = (5, 2, 1)          # by rank of the source, repeating
SHARE = 1.5                  # of all words, dealt to the sources
LIMIT = 2                    # a target's largest multiple of its source's size
SEED = 20260
BROADCAST_BYTES = 8 << 20    # rates are broadcast up to this measured size, else joined by salt
SALTS = 32


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """(source, size) rows -> stored table (source, source_size, weight, target)."""
    per = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
           .repartitionByRange(F.col("source").asc_nulls_last())
           .sortWithinPartitions(F.col("source").asc_nulls_last())
           .withColumn("at", F.monotonically_increasing_id()))
    per = stored(per, "mix-sources")
    # rank = rows in earlier partitions + position in this one; one count per partition comes to the driver
    part = F.shiftrightunsigned("at", 33)
    counts = sorted((r[0], r[1]) for r in per.groupBy(part).count().collect())
    before, offsets = 0, []
    for p, n in counts:
        offsets += [F.lit(p), F.lit(before)]
        before += n
    offset = F.create_map(*offsets)[part] if offsets else F.lit(0)
    rank = offset + F.col("at").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight)
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:                               # each round caps at least one more source
        over = F.col("weight") * level > F.col("source_size") * limit
        n, size, free = per.agg(F.count_if(over), F.sum(F.when(over, F.col("source_size"))),
                                F.sum(F.when(~over, F.col("weight")))).first()
        if n == capped or not free:
            break
        capped, level = n, (share * total - limit * (size or 0)) / free
    target = F.least(F.col("weight") * level, F.col("source_size") * F.lit(float(limit)))
    return stored(per.select("source", "source_size", "weight", target.alias("target")), "mix-targets")


def with_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT, seed: int = SEED) -> DataFrame:
    """``docs`` plus a struct column ``mix``: size, source_size, target, copies, taken."""
    d = docs.withColumn("mix", F.struct(word_count(F.col(text_col)).alias("size")))
    targets = source_targets(d.select(F.col(source_col).alias("source"), F.col("mix.size").alias("size")),
                             weights, share, limit)
    rates = targets.select(F.col("source").alias("__mix_source"),
                           F.struct("source_size", "target").alias("__mix_rate"))
    n_bytes = targets.agg(F.sum(F.lit(64) + F.coalesce(F.octet_length("source"), F.lit(0)))).first()[0] or 0
    same = F.col(source_col).eqNullSafe(F.col("__mix_source"))
    if n_bytes <= BROADCAST_BYTES:
        d = d.join(F.broadcast(rates), same, "left")
    else:
        salted = rates.withColumn("__mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        d = (d.withColumn("__mix_deal", F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int"))
             .join(salted, same & (F.col("__mix_deal") == F.col("__mix_salt")), "left").drop("__mix_deal", "__mix_salt"))
    rate = F.when(F.col("__mix_rate.source_size") > 0,
                  F.col("__mix_rate.target") / F.col("__mix_rate.source_size")).otherwise(0.0)
    # first 13 hex digits of an md5 digest: a uniform draw that any engine can repeat
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f"|{seed}")).cast("binary"))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    copies = F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")
    d = d.withColumn("mix", F.struct(
        F.col("mix.size").alias("size"), F.col("__mix_rate.source_size").alias("source_size"),
        F.col("__mix_rate.target").alias("target"), copies.alias("copies"),
        (copies * F.col("mix.size")).alias("taken")))
    return d.drop("__mix_source", "__mix_rate")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document of ``docs`` as often as the mix takes it."""
    d = with_copies(docs, **options).filter("mix.copies > 0")
    return d.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("mix.copies").cast("int")))).drop("mix")


@register("op10_source_mix", f"""
WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
           FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS ss, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS rk
      FROM s GROUP BY source),
w AS (SELECT *, CASE rk % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS wt FROM p),
o AS (SELECT *, row_number() OVER (ORDER BY ss / wt, rk) AS k, sum(ss) OVER () AS total,
             coalesce(sum(ss) OVER (ORDER BY ss / wt, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
             sum(wt) OVER (ORDER BY ss / wt, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
      FROM w),
l AS (SELECT *, ({SHARE}::DOUBLE * total - 2 * below) / rest AS lam FROM o),
c AS (SELECT lam FROM l WHERE lam * wt <= 2 * ss ORDER BY k LIMIT 1),
t AS (SELECT source, ss, CASE WHEN (SELECT lam FROM c) IS NULL THEN 2.0::DOUBLE * ss
                              ELSE least(wt * (SELECT lam FROM c), 2.0::DOUBLE * ss) END AS target FROM w),
r AS (SELECT doc_id, size, ss, target, CASE WHEN ss > 0 THEN target / ss ELSE 0 END AS rate,
             ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|{SEED}'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, ss AS source_size, target,
       ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM r""")
def op10(spark, sf_dir):
    d = with_copies(read_table(spark, sf_dir, "documents"))
    return d.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")
