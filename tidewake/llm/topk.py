"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit for each dimension: whether it is over zero. Dimensions that a
shorter vector lacks count as not. Codes are cut into segments of WIDTH bits, and codes with equal segments
share a bucket. Round s looks into the buckets whose segment differs from the query's in
just s bits, for all segments. All codes within segments * (s + 1) - 1 bits have then been
seen, so a query is done when its k-th verified distance is at most that; a query whose k-th distance
so far is d looks only into its first d - segments * s + 1 segments, which cover d, and takes only
codes within d. A pair is taken only from the first bucket in which it shows up, so none is seen twice.
The bound on the distance limits what the join makes, not what it compares: codes of a bucket are all
compared, and with queries in proportion to the rows these comparisons grow much faster than the rows.

Equal codes are searched for once, with their smallest ids (k + 1 of them, as a
query is not its own neighbour); so groups of copies neither fill buckets nor drop out. Buckets
with more than BUCKET_CODES codes are dealt out by salt, and probes into them go to each part. Probes are spread by query before they multiply,
and those into buckets without codes go before the shuffle: the list of buckets, at most segments * 2 ** WIDTH, is broadcast if that
is at most MOST_BUCKETS, and joined otherwise.

Ties go by id, of whatever type that can be sorted. Vectors that are null, empty or have a null dimension have no
code: they are neither found nor answered; nor are rows with a null id. Repeated ids are found once each time they occur. Other
columns are ignored, so none can clash. With fewer than k others, all are returned. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewake.llm.common import attach, discard, spread, stored

WIDTH = 16
K = 10
#: Codes to a part of a bucket.
BUCKET_CODES = 2000
SALT_BITS = 24
#: Rows of three numbers that may be broadcast.
MOST_BUCKETS = 1 << 20


def code(vector: Column, segments: int) -> Column:
    """The code of an array column, as an array of whole numbers of WIDTH bits each; or null."""
    whole = F.when((F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull()), vector)
    bit = F.transform(whole, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1), i % WIDTH)).otherwise(F.lit(0)))
    part = lambda j: F.aggregate(F.slice(bit, j * WIDTH + 1, WIDTH), F.lit(0), lambda a, b: a.bitwiseOR(b))
    return F.when(whole.isNotNull(), F.array(*[part(j) for j in range(segments)]))


def differing(a: str, b: str, segments: int) -> list[Column]:
    """Differing bits of two codes, for each segment."""
    return [F.bit_count(F.col(a)[j].bitwiseXOR(F.col(b)[j])) for j in range(segments)]


def place(salt: Column) -> Column:
    """A part of a bucket as one number, by which rows sort without being compared."""
    return F.shiftleft(F.col("j").cast("long"), WIDTH + SALT_BITS).bitwiseOR(F.shiftleft(F.col("part").cast("long"), SALT_BITS)).bitwiseOR(salt.cast("long")).alias("place")


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, neighbour_id, distance): the k nearest others of each query row."""
    spark = vectors.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dimensions = vectors.select(F.max(F.size(vector))).first()[0] or 1
    segments = max(1, -(-dimensions // WIDTH))
    rows = vectors.select(F.col(id_col).alias("id"), code(F.col(vector), segments).alias("code"), F.coalesce(is_query, F.lit(False)).alias("asks")).where("code IS NOT NULL AND id IS NOT NULL")
    rows = stored(rows, "codes")
    kind, total = rows.schema["id"].dataType.simpleString(), rows.count()
    smallest = rows.withColumn("r", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("r") <= k + 1)
    codes = smallest.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    index = stored(codes.select("code", "ids", F.posexplode("code").alias("j", "part")), "index")
    buckets = stored(index.groupBy("j", "part").agg(F.ceil(F.count("*") / BUCKET_CODES).cast("int").alias("salts")), "buckets")
    if segments << WIDTH <= MOST_BUCKETS:
        buckets = F.broadcast(buckets)
    index = index.join(buckets, ["j", "part"]).select(place(F.pmod(F.xxhash64("code"), F.col("salts"))), "code", "ids")
    empty = F.array().cast(f"array<struct<distance:int,id:{kind}>>")
    asked = rows.where("asks").groupBy(F.col("code").alias("q")).agg(F.count("*").alias("n"))
    pending, done = stored(asked.select("q", empty.alias("found")), "pending"), []
    enough = min(k + 1, total)
    last = F.array_max("found")["distance"]
    for s in range(WIDTH + 1):
        before_round = pending
        masks = F.split(F.lit(",".join(str(sum(1 << b for b in c)) for c in combinations(range(WIDTH), s))), ",").cast("array<int>")  # folded to a constant
        pending = pending.withColumn("most", F.when(F.size("found") >= enough, last).otherwise(segments * WIDTH))
        pending = pending.withColumn("looks", F.least(F.lit(segments), F.col("most") - segments * s + 1))
        spread_out = pending.select("q", "most", F.posexplode(F.slice("q", 1, F.col("looks"))).alias("j", "own")).repartition(tasks, "q", "j")
        probes = spread_out.select("q", "most", "j", "own", F.explode(masks).alias("mask")).select("q", "most", "j", F.col("own").bitwiseXOR(F.col("mask")).alias("part"))
        probes = probes.join(buckets, ["j", "part"]).select("q", "most", "j", "part", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        probes = probes.select("q", "most", "j", place(F.col("salt")))
        hits = probes.hint("merge").join(index, "place")  # an explosion looks as small as what explodes, and would be broadcast
        differ = differing("q", "code", segments)
        first = reduce(Column.__and__, [F.when(F.col("j") > i, d > s).otherwise(d >= s) for i, d in enumerate(differ)])
        distance = reduce(Column.__add__, differ)
        seen = hits.where((distance <= F.col("most")) & first).select("q", distance.alias("distance"), F.explode("ids").alias("id"))
        known = pending.select("q", F.explode("found").alias("f")).select("q", "f.distance", "f.id")
        best = seen.union(known).withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy("distance", "id"))).where(F.col("r") <= k + 1)
        best = best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("found"))
        now = pending.select("q", "looks").join(best, "q", "left").select("q", "looks", F.coalesce("found", empty).alias("found"))
        sure = (F.size("found") >= enough) & (F.coalesce(last, F.lit(segments * WIDTH + 1)) <= segments * s + F.col("looks") - 1)
        now = stored(now.withColumn("sure", sure).drop("looks"), "pending")
        discard(before_round)
        done.append(now.where("sure" if s < WIDTH else "true").drop("sure"))
        pending = stored(now.where("not sure").drop("sure"), "pending")
        if pending.isEmpty():
            break
    out = reduce(DataFrame.union, done)
    out = asked.join(out, "q")
    others = attach(rows.where("asks").select(F.col("id").alias("query_id"), "code"), out.withColumnRenamed("q", "code"), "code", spread(F.col("query_id")), total)
    own = F.array_position(F.transform("found", lambda f: f["id"]), F.col("query_id"))
    others = others.withColumn("found", F.slice(F.filter("found", lambda f, i: i + 1 != own), 1, k))
    return others.select("query_id", F.posexplode("found").alias("rank", "f")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("f.id").alias("neighbour_id"), F.col("f.distance").alias("distance"))
