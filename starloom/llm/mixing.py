"""Mixing sources to target weights, with DataFrame functions alone.

The words of each source's documents, laid end to end, are cut into blocks of
a fixed length.  Each output shard draws how many of its slots every source
gets (a multinomial draw: one categorical draw per slot, counted); the k-th
slot that a source gets over all shards is number k of its sequence, and the
sequence runs through the source's blocks in a pseudorandom order, a new one
for each pass (epoch).  Slots beyond a source's target are given up and slots
that the draws left short of it come in a closing shard, so that each source
meets its target to within a block and no block is used more than twice.
Blocks then meet slots in a join by (source, block).

Positions in a source come from two levels of running sums (hash ranges, then
documents within a range), so a source with a third of all rows is spread over
many tasks.  Permutations are swap-or-not shuffles, computed from the slot's
number without any sort.  All draws are functions of fixed seeds and counters:
reruns agree.

Defined results: null and empty texts have size 0 and take 0; the null source
is a source of its own and comes last; repeated rows are documents of their
own; with no words at all every target is 0; further columns are dropped by
``taken`` and kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating; share of all words that the mix takes; most times a source is used.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Words of a block, slots of a shard, documents of a hash range, rounds of the shuffle, cells of the draw.
BLOCK, SHARD, RANGE, ROUNDS, CELLS = 32, 4096, 20_000, 12, 1024
#: Slots of a task, at most about; equal documents of a run.
TASK_SLOTS, COPIES = 1 << 20, 1024
#: The counters' hash works on 31 bits: mask, odd multipliers, step between salts.
BITS, MASK, M1, M2, SALT = 31, (1 << 31) - 1, 1103515245, 1566083941, 1640531527
WIDEST = (1 << 63) - 1


def _shifted(x: Column, by: int) -> Column:
    return x.bitwiseXOR(F.shiftright(x, by))


def mix(x: Column, salt: int = 0) -> Column:
    """31 hashed bits of a counter: shifts and odd multiplications, each of
    which maps the 31-bit numbers onto themselves."""
    t = (_shifted(x.bitwiseAND(F.lit(WIDEST)), BITS).bitwiseAND(F.lit(MASK)) + F.lit(salt * SALT % MASK)).bitwiseAND(F.lit(MASK))
    for by, factor in ((15, M1), (13, M2)):
        t = (_shifted(t, by) * F.lit(factor)).bitwiseAND(F.lit(MASK))
    return _shifted(t, 16)


def _same(doc_id: Column, source: Column, text_hash: Column) -> Column:
    """The key of documents of equal id, source and text."""
    return F.xxhash64(doc_id.isNull(), doc_id, source.isNull(), source, text_hash)


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One small row per id, source and text: its place in the hash order, its
    size and how many documents are equal in them."""
    doc_id, text = docs[id_col].cast("long"), docs[text_col].cast("string")
    rows = docs.select(
        doc_id.alias("doc_id"), docs[source_col].cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64(text).alias("text_hash"))
    # Documents without an id are spread by their texts.
    h = mix(F.coalesce("doc_id", F.col("text_hash").bitwiseAND(F.lit(MASK))))
    return rows.groupBy("doc_id", "source", "size", "text_hash").agg(F.count("*").alias("copies")).withColumns(
        {"h": h, "same": _same(F.col("doc_id"), F.col("source"), F.col("text_hash"))})


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: int = MOST) -> DataFrame:
    """sid, source, source_size, target.  Targets are weight * level, stopped
    at ``most`` times the size.  In order of size per weight, the sources that
    stop come first; the level follows from what they leave."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1)
    one = (sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
           .withColumn("sid", F.row_number().over(order)).withColumn("w", w.cast("double")))
    full = F.col("source_size") * float(most)
    every = Window.orderBy(full / F.col("w"), "sid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    below = Window.orderBy(full / F.col("w"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(every) * share - F.coalesce(F.sum(full).over(below), F.lit(0.0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(below), F.lit(0.0))))
    one = one.withColumn("level", level).withColumn("stops", full < F.col("w") * F.col("level"))
    first = F.min(F.when(~F.col("stops"), F.struct((full / F.col("w")).alias("r"), "sid", "level"))).over(every)
    return one.withColumn("first", first).select(
        "sid", "source", "source_size",
        F.when(F.col("stops"), full).otherwise(F.least(F.col("w") * F.col("first.level"), full)).alias("target"))


def _placed(sized: DataFrame, sources: DataFrame, rows: int) -> DataFrame:
    """Each document with its first word's place among the words of its source,
    and its number among equal ones (``copy``)."""
    ranges = max(1, rows // RANGE)
    at = sized.join(sources.select("sid", "source"), sized["source"].eqNullSafe(sources["source"])).select(
        "sid", "doc_id", "size", "text_hash", "same", "copies", "h", F.shiftright(F.col("h") * ranges, BITS).alias("range"))
    # A range that one id (or one document, many times) crowds is cut finer: by
    # place, then by the text's hash, then by runs of equal documents.
    crowded = at.groupBy("sid", "range").agg(F.sum("copies").alias("n")).filter(F.col("n") > 4 * RANGE).select(
        "sid", "range", F.lit(True).alias("crowded"))
    fine = lambda c: F.when(F.col("crowded"), c).otherwise(F.lit(0))
    at = at.join(crowded, ["sid", "range"], "left").withColumn(
        "run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES)))).withColumns({
            "n": F.least(F.col("copies") - F.col("run") * COPIES, F.lit(COPIES)), "place": fine(F.col("h")),
            "slice": fine(F.shiftright("text_hash", 54)), "bundle": fine(F.floor(F.col("run") / 16))})
    group = ["range", "place", "slice", "bundle"]
    before = Window.partitionBy("sid").orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    words = F.sum(F.col("size") * F.col("n"))
    starts = at.groupBy("sid", *group).agg(words.alias("words")).select(
        "sid", *group, F.coalesce(F.sum("words").over(before), F.lit(0)).alias("group_start"))
    within = Window.partitionBy("sid", *group).orderBy("h", "doc_id", "size", "text_hash", "run").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    runs = at.join(starts, ["sid", *group]).withColumn(
        "off", F.col("group_start") + words.over(within) - F.col("size") * F.col("n"))
    return runs.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).select(
        "sid", "doc_id", "size", "same", "copies", (F.col("run") * COPIES + F.col("k")).alias("copy"),
        (F.col("off") + F.col("k") * F.col("size")).alias("off"))


def _keys(sid: Column, epoch: Column, n: Column) -> Column:
    """Partner sums and hash salts of the shuffle's rounds, one after the other."""
    def of(r):
        seed = sid.cast("long") * 1000003 + epoch * 10007 + r * 101
        return F.struct(F.pmod(mix(seed) * 32768 + mix(seed, 1).bitwiseAND(F.lit(32767)), n).alias("k"), mix(seed, 2).alias("c"))
    return F.transform(F.sequence(F.lit(1).cast("long"), F.lit(ROUNDS).cast("long")), of)


def _shuffled(x: Column, n: Column, keys: Column) -> Column:
    """Swap-or-not: in each round x and its partner (k - x) mod n stay or swap by one hashed bit of the larger."""
    def step(at, key):
        partner = F.when(key["k"] >= at, key["k"] - at).otherwise(key["k"] - at + n)
        top = F.greatest(at, partner)
        t = _shifted(top, BITS).bitwiseXOR(key["c"]).bitwiseAND(F.lit(MASK))
        return F.when((_shifted(t, 15) * F.lit(M1)).bitwiseAND(F.lit(MASK)) > F.lit(MASK // 2), partner).otherwise(at)
    return F.aggregate(keys, x, step)


def slots(sources: DataFrame, total_slots: int, shard_slots: int = SHARD) -> DataFrame:
    """shard, sid, block of every slot of the mix."""
    spark = sources.sparkSession
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    odds = (sources.filter("slots > 0").withColumn("high", F.sum("slots").over(upto))
            .withColumn("low", F.col("high") - F.col("slots")))
    # A draw is a number below total_slots; cells turn the search for its source into an equi-join.
    width = max(1, -(-total_slots // CELLS))
    cells = odds.select("sid", "low", "high", F.explode(F.sequence(
        F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell"))
    tasks = max(spark.sparkContext.defaultParallelism, total_slots // TASK_SLOTS)
    draws = spark.range(0, total_slots, 1, tasks).select(
        F.floor(F.col("id") / shard_slots).alias("shard"), mix(F.col("id"), 3).alias("a"), mix(F.col("id"), 4).alias("b"))
    draws = draws.select("shard", F.pmod(F.col("a") * (MASK + 1) + F.col("b"), F.lit(total_slots)).alias("u"))
    counts = (draws.withColumn("cell", F.floor(F.col("u") / width)).join(cells, "cell")
              .filter("u >= low AND u < high").groupBy("shard", "sid").agg(F.count("*").alias("n")))
    before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    drawn = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    sums = counts.groupBy("sid").agg(F.sum("n").alias("got"))
    closing = sources.join(sums, "sid", "left").select(
        F.lit(-(-total_slots // shard_slots)).cast("long").alias("shard"), "sid",
        (F.col("slots") - F.coalesce("got", F.lit(0))).alias("n"), F.coalesce("got", F.lit(0)).alias("first"))
    # A run of numbers [first, first + n) up to the target, split where an epoch ends.
    runs = drawn.select("shard", "sid", "n", "first").unionByName(closing).join(
        sources.select("sid", "slots", "blocks"), "sid").select(
        "shard", "sid", "blocks", "first", F.least(F.col("first") + F.col("n"), "slots").alias("upto"))
    runs = runs.filter("upto > first").select("shard", "sid", "blocks", F.explode(F.transform(
        F.sequence(F.floor(F.col("first") / F.col("blocks")), F.floor((F.col("upto") - 1) / F.col("blocks"))),
        lambda e: F.struct(e.alias("epoch"), F.greatest(F.col("first"), e * F.col("blocks")).alias("a"),
                           F.least(F.col("upto"), (e + 1) * F.col("blocks")).alias("b")))).alias("r"))
    runs = runs.select("shard", "sid", "blocks", "r.epoch", "r.a", "r.b",
                       _keys(F.col("sid"), F.col("r.epoch"), F.col("blocks")).alias("keys"))
    numbers = runs.repartition(tasks, "shard", "sid", "epoch").withColumn("q", F.explode(F.sequence("a", F.col("b") - 1)))
    return numbers.select("shard", "sid", "epoch", _shuffled(F.pmod("q", "blocks"), F.col("blocks"), F.col("keys")).alias("block"))


class Mix:
    """The small tables of one mix: sources, placed documents, slots."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 block: int = BLOCK):
        self.block = block
        sized = written(_sized(docs, id_col, text_col, source_col), "mix-sizes")
        targets = source_targets(sized)
        blocks = F.ceil(F.col("source_size") / block)
        self.sources = written(targets.withColumn("blocks", blocks).withColumn(
            "slots", F.least(F.round(F.col("target") * blocks / F.greatest("source_size", F.lit(1))).cast("long"),
                             blocks * MOST)), "mix-sources")
        seen = self.sources.agg(F.coalesce(F.sum("slots"), F.lit(0)).alias("slots")).head()
        self.total_slots = int(seen["slots"])
        self.sized = sized
        self.placed = _placed(sized, self.sources, int(sized.agg(F.coalesce(F.sum("copies"), F.lit(0))).head()[0]))

    def slots(self) -> DataFrame:
        return slots(self.sources, self.total_slots)

    def pieces(self) -> DataFrame:
        """A row per document and block that holds words of it: where in the
        document they start, how many they are, and in which epochs the block
        is taken (blocks never taken have a null)."""
        uses = self.slots().select("sid", "block", "epoch")
        cut = self.placed.filter("size > 0").select("*", F.explode(F.sequence(
            F.floor(F.col("off") / self.block), F.floor((F.col("off") + F.col("size") - 1) / self.block))).alias("block"))
        start = F.greatest(F.col("block") * self.block - F.col("off"), F.lit(0))
        stop = F.least((F.col("block") + 1) * self.block - F.col("off"), "size")
        cut = cut.select("sid", "block", "doc_id", "size", "same", "copies", "copy", "off", start.alias("start"), (stop - start).alias("n"))
        return cut.join(uses, ["sid", "block"], "left")

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken of every document."""
        some = self.pieces().groupBy("sid", "off", "doc_id", "size").agg(
            F.sum(F.when(F.col("epoch").isNotNull(), F.col("n")).otherwise(0)).alias("taken"))
        none = self.placed.filter("size = 0").select("sid", "off", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
        return some.unionByName(none).join(self.sources.select("sid", "source_size", "target"), "sid").select(
            "doc_id", "size", "source_size", "target", "taken")


def taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return Mix(docs, id_col, text_col, source_col).taken()


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows (doc, same) with their number (``copy``) among those of one
    ``same``: by a hash of all columns, then as they lie.  Counted by input
    task first, so equal rows, however many, are never gathered."""
    at = rows.withColumns({"like": F.xxhash64("doc"), "part": F.shiftright(F.monotonically_increasing_id(), 33)})
    group = ["same", "like", "part"]
    before = Window.partitionBy("same").orderBy("like", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = at.groupBy(*group).agg(F.count("*").alias("n")).select(*group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return at.withColumn("nth", F.row_number().over(Window.partitionBy(*group).orderBy(F.lit(0)))).join(starts, group).select(
        "doc", "same", (F.col("start") + F.col("nth") - 1).alias("copy"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as documents: for each epoch that takes words of a document, a
    row with all its columns whose text holds just these words (the text as it
    is when all are taken); documents that the mix leaves out don't appear."""
    plan = Mix(docs, id_col, text_col, source_col)
    picks = plan.pieces().filter("epoch IS NOT NULL").groupBy("sid", "off", "same", "copies", "copy", "size", "epoch").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list("start")).alias("starts"))
    # The document is one column, so its own names meet none of the plan's; its
    # text is in it alone, so that it moves once.
    same = _same(docs[id_col].cast("long"), docs[source_col].cast("string"), F.xxhash64(docs[text_col].cast("string")))
    rows = docs.select(F.struct("*").alias("doc"), same.alias("same"))
    # Documents that have no equal meet their picks by key alone: one shuffle of
    # the texts.  Equal ones are numbered and meet by key and number.
    repeated = written(plan.sized.filter("copies > 1").select("same"), "mix-repeated")
    alone = rows.join(repeated, "same", "left_anti").join(picks.filter("copies = 1"), "same")
    of_many = _numbered(rows.join(repeated, "same", "left_semi")).join(picks.filter("copies > 1"), ["same", "copy"])
    need = ["doc", "n", "size", "off", "starts"]
    out = alone.select(*need).unionByName(of_many.select(*need)).withColumn("text", F.col("doc").getField(text_col).cast("string"))
    # A text's pieces, as blocks cut it: the words up to the first block's end, then block by block.
    word = r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++)"
    first = plan.block - F.pmod("off", F.lit(plan.block))
    head = F.regexp_substr("text", F.concat(F.lit(f"^{word}{{1,"), first.cast("string"), F.lit("}+")))
    tail = F.regexp_extract_all(F.substr("text", F.length("head") + 1), F.lit(f"{word}{{1,{plan.block}}}+"), F.lit(0))
    whole = F.col("n") == F.col("size")
    out = out.withColumn("head", F.when(~whole, head)).withColumn("pieces", F.when(~whole, F.concat(F.array("head"), tail)))
    number = lambda start: F.when(start == 0, 0).otherwise((start - first) / plan.block + 1).cast("int")
    some = F.array_join(F.transform("starts", lambda start: F.get("pieces", number(start))), "")
    text = F.when(whole, F.col("text")).otherwise(some)
    return out.select(*((text if c == text_col else F.col("doc").getField(c)).alias(c) for c in docs.columns))


def _sql_mix(x: str, salt: int = 0) -> str:
    t = f"((xor(({x}) & {WIDEST}, (({x}) & {WIDEST}) >> {BITS}) & {MASK}) + {salt * SALT % MASK}) & {MASK}"
    for by, factor in ((15, M1), (13, M2)):
        t = f"list_transform([{t}], lambda t: (xor(t, t >> {by}) * {factor}) & {MASK})[1]"
    return f"list_transform([{t}], lambda t: xor(t, t >> 16))[1]"


def sql() -> str:
    """The query's rows in DuckDB SQL: slots are numbers below a source's
    count, whichever shard draws them."""
    q = ", ".join(map(str, WEIGHTS))
    seed = "(sid * 1000003 + epoch * 10007 + {r} * 101)"
    steps = ["p0 AS (SELECT sid, n, q // n AS epoch, q % n AS x FROM q)"]
    for r in range(1, ROUNDS + 1):
        s = seed.format(r=r)
        steps.append(
            f"k{r} AS (SELECT sid, n, epoch, x, (({_sql_mix(s)} * 32768 + ({_sql_mix(s, 1)} & 32767)) % n - x + n) % n AS o, "
            f"{_sql_mix(s, 2)} AS c FROM p{r - 1}), "
            f"p{r} AS (SELECT sid, n, epoch, CASE WHEN (xor(t, t >> 15) * {M1}) & {MASK} > {MASK // 2} THEN o ELSE x END AS x FROM "
            f"(SELECT *, xor(xor(greatest(x, o), greatest(x, o) >> {BITS}), c) & {MASK} AS t FROM k{r}))")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, {_sql_mix('coalesce(doc_id, -1)')} AS h,
                  coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM s0),
s2 AS (SELECT *, ([{q}])[((sid - 1) % {len(WEIGHTS)} + 1)::INT]::DOUBLE AS w FROM s1),
s3 AS (SELECT *, (sum(source_size) OVER () * {SHARE} - coalesce(sum(source_size * {float(MOST)}) OVER b, 0))
              / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level FROM s2
       WINDOW b AS (ORDER BY source_size * {float(MOST)} / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, source_size * {float(MOST)} < w * level AS stops FROM s3),
s5 AS (SELECT *, (SELECT arg_min(level, (source_size * {float(MOST)} / w, sid)) FROM s4 WHERE NOT stops) AS top FROM s4),
src AS (SELECT sid, source, source_size,
               CASE WHEN stops THEN source_size * {float(MOST)} ELSE least(w * top, source_size * {float(MOST)}) END AS target,
               ((source_size + {BLOCK - 1}) // {BLOCK})::BIGINT AS n FROM s5),
m AS (SELECT *, least(round(target * n / greatest(source_size, 1))::BIGINT, {MOST} * n) AS slots FROM src),
q AS (SELECT sid, n, unnest(range(slots)) AS q FROM m WHERE n > 0),
{', '.join(steps)},
uses AS (SELECT sid, x AS block, count(*) AS uses FROM p{ROUNDS} GROUP BY ALL),
o AS (SELECT r, sid, doc_id, size, source_size, target,
             (sum(size) OVER (PARTITION BY sid ORDER BY h, doc_id NULLS FIRST, size, r ROWS UNBOUNDED PRECEDING))::BIGINT - size AS off
      FROM d JOIN src ON d.source IS NOT DISTINCT FROM src.source),
c AS (SELECT r, sid, off, size, unnest(range(off // {BLOCK}, (off + size - 1) // {BLOCK} + 1)) AS block FROM o WHERE size > 0),
t AS (SELECT r, sum((least((c.block + 1) * {BLOCK} - off, size) - greatest(c.block * {BLOCK} - off, 0)) * uses)::BIGINT AS taken
      FROM c JOIN uses ON c.sid = uses.sid AND c.block = uses.block GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM o LEFT JOIN t USING (r)
"""
