"""Operator 2, mixing sources to target weights. Built-in expressions only.

The words of a source are packed into blocks of fixed length. Draws decide how many blocks
each output shard takes of each source; a source's draws are its slots 0, 1, 2, ... A slot finds
its block through a pseudorandom permutation of the source's block numbers, a new one for
each pass over them, and slots meet documents in a join on source and block number. No pass
is begun before the last one is through, so with targets of at most twice a source no block
is taken more than twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendaval.llm.shared import WORD, keep, running_total


@dataclass(frozen=True)
class Mix:
    """Parameters of a mix; the seed makes reruns agree."""

    weights: Sequence[int] = (3, 1, 2)  # dealt to the sources in order, repeating
    share: float = 1.5  # words of the mix, as a multiple of all words
    most: int = 2  # passes over a source at most
    block: int = 64  # words in a block
    shards: int = 8  # output shards, each with a draw of its own
    rounds: int = 24  # rounds of the index permutation
    chunk: int = 1 << 13  # slots made from one row
    seed: int = 7


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """One row per source with its target, from rows (source, source_size).

    Targets share ``mix.share`` of all words by weight; what would exceed ``mix.most`` times
    a source goes to the others by weight, until none exceeds it. That level is found in
    one pass: sources ordered by the level at which they fill up, the first k of them full.
    The windows hold one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    numbered = sizes.withColumn("number", F.row_number().over(order) - 1).select(
        "source",
        "number",
        "source_size",
        weights[F.col("number") % len(mix.weights)].alias("weight"),
        (F.col("source_size") * float(mix.most)).alias("full"),
    )
    fills = Window.orderBy(F.col("full") / F.col("weight"), "number")
    upto = fills.rowsBetween(Window.unboundedPreceding, 0)
    all_rows = Window.partitionBy()
    levels = numbered.select(
        "*",
        F.sum("full").over(upto).alias("full_upto"),
        F.sum("weight").over(upto).alias("weight_upto"),
        F.sum("weight").over(all_rows).alias("weight_all"),
        (F.sum("source_size").over(all_rows) * float(mix.share)).alias("wanted"),
    )
    # The level if all that fill up earlier are full and the rest is open. It is right for the
    # first source that stays under its cap; for later ones it is lower.
    open_weight = F.col("weight_all") - F.col("weight_upto") + F.col("weight")
    level = (F.col("wanted") - F.col("full_upto") + F.col("full")) / open_weight
    tried = levels.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("full"), F.col("level"))
    found = tried.withColumn("level", F.max(fits).over(all_rows))
    target = F.least(F.col("full"), F.col("level") * F.col("weight"))
    blocks = F.ceil(F.col("source_size") / mix.block).cast("long")
    return found.select(
        "source",
        "number",
        "source_size",
        F.coalesce(target, "full").alias("target"),
        blocks.alias("blocks"),
        F.coalesce(F.try_divide(F.coalesce(target, "full") * blocks, F.col("source_size")), F.lit(0.0)).alias(
            "slots"
        ),
    )


def drawn_counts(targets: DataFrame, mix: Mix) -> DataFrame:
    """(number, blocks, shard, first, slots): the slots of each source in each output shard.

    A source has as many slots as meet its target to the nearest block. Each shard takes an
    equal whole part of them, and what the parts leave over, fewer than there are shards, is
    drawn: each goes to a shard of its own draw, so the counts of a source are multinomial and
    add up to its slots.
    """
    total = F.least(F.floor(F.col("slots") + 0.5), F.col("blocks") * mix.most)
    whole = targets.select(
        "number",
        "blocks",
        F.floor(total / mix.shards).alias("whole"),
        F.pmod(total, F.lit(mix.shards)).cast("int").alias("rest"),
        F.explode(F.sequence(F.lit(0), F.lit(mix.shards - 1))).alias("shard"),
    )
    drawn = F.expr(
        "size(filter(slice(sequence(1, greatest(rest, 1)), 1, rest),"
        f" draw -> pmod(xxhash64({mix.seed}, number, draw), {mix.shards}) = shard))"
    )
    counts = whole.select("number", "blocks", "shard", (F.col("whole") + drawn).alias("slots"))
    earlier = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("slots").over(earlier), F.lit(0)))


def permuted(index: Column, size: Column, key: Column, rounds: int) -> Column:
    """A permutation of 0 .. size - 1 chosen by ``key``: the swap-or-not shuffle.

    Each round pairs every index with a partner and swaps the pairs whose hash says so.
    """

    def turn(x: Column, r: Column) -> Column:
        partner = F.pmod(F.xxhash64(key, r) - x, size)
        swap = F.pmod(F.xxhash64(key, r, F.greatest(x, partner)), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, turn)


def drawn_blocks(counts: DataFrame, mix: Mix) -> DataFrame:
    """(number, shard, slot, turn, block): which block each slot takes, in which pass."""
    wanted = counts.where("slots > 0")
    chunks = wanted.select("*", F.explode(F.expr(f"sequence(0L, slots - 1, {mix.chunk}L)")).alias("at"))
    # By number, so that the few rows stay apart: each becomes many.
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(tasks, "number", "shard", "at")
    last = F.least(F.col("at") + mix.chunk, F.col("slots")) - 1
    slots = chunks.select(
        "number", "shard", "blocks", F.explode(F.sequence("at", last)).alias("nth"), "first"
    ).withColumn("slot", F.col("first") + F.col("nth"))
    turn = F.floor(F.col("slot") / F.col("blocks")).cast("int")
    key = F.xxhash64(F.lit(mix.seed), "number", "turn")
    slots = slots.withColumn("turn", turn).withColumn("key", key)
    block = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("key"), mix.rounds)
    return slots.select("number", "shard", "slot", "turn", block.alias("block"))


@dataclass(frozen=True)
class Mixed:
    """What a mix decides: targets by source, places of the documents, taken blocks by slot."""

    measured: DataFrame  # doc_id, source, tie, size
    targets: DataFrame
    places: DataFrame  # doc_id, number, tie, size, start
    slots: DataFrame


def _measured(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id",
        "source",
        F.xxhash64("text").alias("tie"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def plan_mix(documents: DataFrame, mix: Mix) -> Mixed:
    """Plans a mix of documents (doc_id, source, text).

    A null source is a source of its own. Texts without words, or null, have size 0 and no
    place. Repeated rows are laid out one after the other, each with its own words.
    """
    measured = keep(_measured(documents), "mix_sizes")
    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = keep(source_targets(sizes, mix), "mix_targets")
    same_source = F.col("m.source").eqNullSafe(F.col("t.source"))
    numbered = (
        measured.where("size > 0")
        .alias("m")
        .join(targets.select("source", "number").alias("t"), same_source)
        .select("doc_id", "number", "tie", "size")
    )
    places = keep(running_total(numbered, "number", ["doc_id", "tie"], "size", "start"), "mix_places")
    slots = keep(drawn_blocks(drawn_counts(targets, mix), mix), "mix_slots")
    return Mixed(measured, targets, places, slots)


def taken_spans(mixed: Mixed, mix: Mix) -> DataFrame:
    """(doc_id, number, tie, size, start, turn, block, begin, words): parts of documents taken.

    ``begin`` counts the document's words from 0; one row per part, block and pass.
    """
    last = F.col("start") + F.col("size") - 1
    parts = mixed.places.select(
        "*",
        F.explode(
            F.sequence(F.floor(F.col("start") / mix.block), F.floor(last / mix.block))
        ).alias("block"),
    )
    begin = F.greatest("start", F.col("block") * mix.block)
    end = F.least(last + 1, (F.col("block") + 1) * mix.block)
    # Both sides grow with the documents, more than the sizes before explode() let on.
    taken = mixed.slots.select("number", "block", "turn").hint("merge")
    return parts.join(taken, ["number", "block"]).select(
        "doc_id",
        "number",
        "tie",
        "size",
        "start",
        "turn",
        "block",
        (begin - F.col("start")).alias("begin"),
        (end - begin).alias("words"),
    )


def mix_report(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), one row per row of ``documents``."""
    mixed = plan_mix(documents, mix)
    taken = taken_spans(mixed, mix).groupBy("number", "start").agg(F.sum("words").alias("taken"))
    sized = mixed.places.join(taken, ["number", "start"], "left").select(
        "doc_id", "number", "size", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
    zero = mixed.measured.where("size = 0").select("doc_id", "source", "size", F.lit(0).cast("long").alias("taken"))
    named = sized.join(mixed.targets.select("number", "source"), "number")
    rows = named.select("doc_id", "source", "size", "taken").unionByName(zero).alias("r")
    of = mixed.targets.select("source", "source_size", "target").alias("t")
    return rows.join(of, F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        "doc_id", "r.source", "size", "source_size", "target", "taken"
    )


def mix_texts(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself, with the columns of ``documents`` (doc_id, source, text, ...).

    One row per document and pass that takes any of its words: the text whole if all of its
    words are taken, else the taken words in order, parted by single spaces. Documents of
    which nothing is taken are not in the mix, null and empty texts among them. ``n_chars`` is
    set anew where it exists; other columns stay as they are, whatever their names. Rows alike
    in id, source and text are one row with all their copies; very long texts are cut by the
    same rule. An empty table gives no rows.
    """
    mixed = plan_mix(documents, mix)
    whole = taken_spans(mixed, mix).groupBy("doc_id", "number", "tie", "size", "start", "turn")
    # A document's taken parts, at most its words / mix.block of them.
    spans = whole.agg(F.sum("words").alias("n"), F.sort_array(F.collect_list(F.struct("begin", "words"))).alias("parts"))
    copies = spans.groupBy("doc_id", "number", "tie").agg(F.collect_list(F.struct("n", "size", "parts")).alias("copies"))
    copies = copies.join(mixed.targets.select("number", "source"), "number")
    copies = copies.select("doc_id", "source", "tie", F.explode("copies").alias("copy")).alias("c")
    # Rows alike in id, source and text stand for one another; the first gives all their copies.
    texts = documents.select(
        "doc_id",
        "source",
        F.xxhash64("text").alias("tie"),
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
    )
    single = texts.dropDuplicates(["doc_id", "source", "tie"]).alias("d")
    alike = F.col("d.tie") == F.col("c.tie")
    for c in ("doc_id", "source"):
        alike &= F.col(f"d.{c}").eqNullSafe(F.col(f"c.{c}"))
    joined = single.join(copies, alike).select("d.row", "c.copy")
    # An array of one, so that a text is parted into words once and not for each of its parts.
    pieces = F.expr(
        f"transform(array(regexp_extract_all(row.text, r'({WORD})', 1)), words -> concat_ws(' ', flatten("
        "transform(copy.parts, p -> slice(words, cast(p.begin + 1 as int), cast(p.words as int))))))[0]"
    )
    whole = F.col("copy.n") == F.col("copy.size")
    made = joined.withColumn("cut", F.when(whole, F.col("row.text")).otherwise(pieces))
    out = {"text": F.col("cut"), "n_chars": F.length("cut").cast("long")}
    return made.select(*[out[c].alias(c) if c in out else F.col(f"row.`{c}`").alias(c) for c in documents.columns])
