"""The trie of conversation prefixes, with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns; it is known by two 64-bit words, each the XOR of hashes of
(position, role, text) over its turns. Totals of subtrees come from contraction rounds, each of them
joins of whole tables: *rake* takes all leaves off and adds their totals to their parents, *compress*
takes an independent third of the nodes out of every chain of only children and lets the child hang from
its grandparent, with the sum passed over noted on its edge. A tree of any shape is gone after a number
of rounds that grows with the logarithm of its size. Then the nodes that were compressed are expanded
again: their total is a known sum plus the total of a child that stayed longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.tables import prepared
from marquee.session import materialise

#: Conversations share the opening of the one whose id ends their block of so many ids.
BLOCK = 20
#: At most so many opening turns are taken over, less one.
OPENINGS = 4
#: Turns of one conversation are scanned in runs of so many, so that no conversation needs one long window.
RUN = 1024
#: Member ids of a node are joined in runs of 2 ** RUN_BITS consecutive ids.
RUN_BITS = 12
#: Rows of a task in a round of the contraction.
ROUND_ROWS = 100_000
WORD = r"[^\x20\x09-\x0D]+"
ROOT = "named_struct('a', 0L, 'b', 0L)"


def openings(conv_id: Column) -> Column:
    """How many opening turns a conversation takes over."""
    return F.crc32(conv_id.cast("string").cast("binary")) % OPENINGS


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, part, at, digest, n_words), sorted: the k-th turn of a conversation is known by ``numbering``.

    Order: turn, null first, then role and text, a null of either being empty. Rows alike in all of these
    are one turn each. Rows without conv_id belong to no conversation. A conversation may cover many parts.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    held = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.monotonically_increasing_id().alias("given"),
    ).where(F.col("conv_id").isNotNull())
    order = ["conv_id", "turn", "role", "text", "given"]  # ascending: null first
    ranged = held.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(
        ranged.select(
            "conv_id",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("at"),
            digest.alias("digest"),
            F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("n_words"),
        ),
        "turns",
    )


def numbering(turns: DataFrame) -> DataFrame:
    """(conv_id, part, first_at, before, total): the turn at ``at`` is number before + at - first_at + 1."""
    pieces = turns.groupBy("conv_id", "part").agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("conv_id")
    earlier = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.select("conv_id", "part", "first_at", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(own).alias("total"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos, digest, n_words) and lengths (conv_id, length) of the rebuilt conversations.

    Conversation c is made of the first ``openings`` turns of conversation c - c % BLOCK (a remainder is
    never below zero), all if it has fewer and none if there is no such conversation, and of its own turns after as many.
    """
    held = numbered_turns(turns)
    pieces = materialise(numbering(held), "numbering")
    placed = held.join(pieces, ["conv_id", "part"]).withColumn("k", F.col("before") + F.col("at") - F.col("first_at") + 1)
    first = pieces.where((F.col("before") < OPENINGS) & (F.pmod("conv_id", F.lit(BLOCK)) == 0)).select("conv_id", "part")
    heads = placed.join(first, ["conv_id", "part"], "left_semi").where(F.col("k") < OPENINGS)
    heads = heads.select(F.col("conv_id").alias("block"), F.col("k").alias("pos"), "digest", "n_words")

    takes = openings(F.col("conv_id")).alias("takes")
    convs = pieces.select("conv_id", "total").distinct().select("conv_id", "total", takes, (F.col("conv_id") - F.pmod("conv_id", F.lit(BLOCK))).alias("block"))
    known = heads.groupBy("block").agg(F.count(F.lit(1)).alias("known"))
    taken = F.least(F.col("takes"), F.coalesce("known", F.lit(0)))
    convs = convs.join(known, "block", "left").select("conv_id", "block", "takes", "total", taken.alias("taken"))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("total") - F.col("takes"), F.lit(0)))

    opening = convs.select("conv_id", "block", "taken").join(heads, "block").where(F.col("pos") <= F.col("taken"))
    shift = pieces.join(convs.select("conv_id", "takes", "taken"), "conv_id")
    own = held.join(shift, ["conv_id", "part"]).withColumn("k", F.col("before") + F.col("at") - F.col("first_at") + 1)
    own = own.where(F.col("k") > F.col("takes")).withColumn("pos", F.col("k") - F.col("takes") + F.col("taken"))
    columns = ["conv_id", F.col("pos").cast("bigint").alias("pos"), "digest", "n_words"]
    return own.select(*columns).unionByName(opening.select(*columns)), convs.select("conv_id", "length")


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, n_words, ends) of every prefix of every conversation, the empty one too."""
    run = ((F.col("pos") - 1) / RUN).cast("bigint")
    # The lane comes first: it is the seed of all that follows, so the two words are independent.
    marks = [F.xxhash64(F.lit(lane), "pos", "digest").alias(lane) for lane in "ab"]
    marked = turns.select("conv_id", "pos", "n_words", run.alias("run"), *marks)
    runs = marked.groupBy("conv_id", "run").agg(*(F.expr(f"bit_xor({c})").alias(f"{c}_run") for c in "ab"))
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    carried = runs.select("conv_id", "run", *(F.expr(f"bit_xor({c}_run)").over(earlier).alias(f"{c}_before") for c in "ab"))
    carried = carried.where(F.col("run") > 0)  # few rows: only conversations of more than RUN turns
    inside = Window.partitionBy("conv_id", "run").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = marked.select("*", *(F.expr(f"bit_xor({c})").over(inside).alias(f"{c}_own") for c in "ab"))
    full = summed.join(carried, ["conv_id", "run"], "left")
    keys = {c: F.col(f"{c}_own").bitwiseXOR(F.coalesce(f"{c}_before", F.lit(0).cast("bigint"))) for c in "ab"}
    full = full.join(lengths, "conv_id").select(
        "conv_id",
        F.col("pos").alias("depth"),
        F.struct(*(keys[c].alias(c) for c in "ab")).alias("node"),
        F.struct(*(keys[c].bitwiseXOR(F.col(c)).alias(c) for c in "ab")).alias("parent"),
        "n_words",
        (F.col("pos") == F.col("length")).alias("ends"),
    )
    empty = lengths.select(
        "conv_id",
        F.lit(0).cast("bigint").alias("depth"),
        F.expr(ROOT).alias("node"),
        F.lit(None).cast("struct<a:bigint,b:bigint>").alias("parent"),
        F.lit(0).cast("bigint").alias("n_words"),
        (F.col("length") == 0).alias("ends"),
    )
    return full.unionByName(empty)


def nodes_of(paths: DataFrame) -> DataFrame:
    """(node, depth, parent, conv_id, n_convs, weight, n_children) of every distinct prefix."""
    found = paths.groupBy("depth", "node").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("parent").alias("parent"), F.min("n_words").alias("n_words")
    )
    found = found.withColumn("weight", (F.col("n_convs") - 1) * F.col("n_words")).drop("n_words")
    children = found.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    return materialise(found.join(children, "node", "left").fillna(0, ["n_children"]), "trie")


def _rank(node: str) -> Column:
    """A fresh random order of the nodes for every round.

    The round is a column: with a number in the plan every round would compile code of its own in the driver.
    """
    return F.xxhash64("turn", F.col(f"{node}.a"), F.col(f"{node}.b"))


def _in_tasks(df: DataFrame, rows: int) -> DataFrame:
    """Rounds shrink geometrically, and their tasks with them: at least ROUND_ROWS rows each."""
    return df.coalesce(max(1, -(-rows // ROUND_ROWS)))


def contraction_round(alive: DataFrame) -> DataFrame:
    """One rake and one compress. ``alive``: (node, up, leaves, saved, edge_leaves, edge_saved, kids, turn).

    Returned with ``gone`` and ``child``: rows that are gone were compressed and point to their child;
    the others are alive. Rows of ``alive`` without kids are raked: their totals are final.
    """
    leaf = F.col("kids") == 0
    told = alive.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("node")).agg(
        *(F.sum(F.when(leaf, F.col(c) + F.col(f"edge_{c}")).otherwise(0)).alias(f"add_{c}") for c in ("leaves", "saved")),
        F.count_if(~leaf).alias("left"),
        F.max(F.when(~leaf, F.struct("node", "edge_leaves", "edge_saved"))).alias("only"),
    )
    raked = alive.where(~leaf).join(told, "node").select(
        "node",
        "up",
        *((F.col(c) + F.col(f"add_{c}")).alias(c) for c in ("leaves", "saved")),
        "edge_leaves",
        "edge_saved",
        F.col("left").alias("kids"),
        "turn",
        F.when(F.col("left") == 1, F.col("only")).alias("only"),
    )
    # Higher in rank than both neighbours: two neighbours are never taken out in one round.
    highest = (_rank("node") > _rank("up")) & (_rank("node") > _rank("only.node"))
    raked = raked.withColumn("gone", F.col("only").isNotNull() & F.col("up").isNotNull() & highest)
    # One row for a child at most, so no key is hot, however many children a node has.
    moved = raked.where("gone").select(
        F.col("only.node").alias("node"),
        F.col("up").alias("new_up"),
        *((F.col(c) + F.col(f"edge_{c}")).alias(f"over_{c}") for c in ("leaves", "saved")),
    )
    return raked.join(moved, "node", "left").select(
        "node",
        F.coalesce("new_up", "up").alias("up"),
        # Of a compressed node, what its child does not bring along.
        *((F.col(c) + F.when(F.col("gone"), F.col(f"only.edge_{c}")).otherwise(0)).alias(c) for c in ("leaves", "saved")),
        *((F.col(f"edge_{c}") + F.coalesce(f"over_{c}", F.lit(0))).alias(f"edge_{c}") for c in ("leaves", "saved")),
        "kids",
        (F.col("turn") + 1).alias("turn"),
        "gone",
        F.when(F.col("gone"), F.col("only.node")).alias("child"),
    )


def subtree_totals(tree: DataFrame) -> DataFrame:
    """(node, leaves, saved): sums over the subtree of every row of ``tree`` (node, parent, n_children, weight).

    ``leaves`` counts the childless nodes, ``saved`` adds the weights. The tree may have any shape: the
    number of rounds grows with the logarithm of its size, for stars and for chains alike.
    """
    childless = F.col("n_children") == 0
    zero = F.lit(0).cast("bigint")
    alive = tree.select(
        "node",
        F.col("parent").alias("up"),
        childless.cast("bigint").alias("leaves"),
        F.col("weight").cast("bigint").alias("saved"),
        zero.alias("edge_leaves"),
        zero.alias("edge_saved"),
        F.col("n_children").alias("kids"),
        F.lit(0).alias("turn"),
    )
    totals, spliced, turn = [], [], 0
    while True:
        totals.append(alive.where(F.col("kids") == 0).select("node", "leaves", "saved"))
        inner = alive.where(F.col("kids") > 0).count()
        if not inner:
            break
        after = materialise(_in_tasks(contraction_round(alive), inner), f"round-{turn}")
        spliced.append(after.where("gone").select("node", "child", "leaves", "saved"))
        alive = after.where(~F.col("gone"))
        turn += 1
    known = reduce(DataFrame.unionByName, totals)
    if not spliced:
        return known
    links = reduce(DataFrame.unionByName, spliced)
    n_links = links.count()
    # A compressed node's child was compressed in a later round, if at all, so there are at most ``turn``
    # links in a row. Each pass halves them.
    for step in range((turn - 1).bit_length()):
        then = links.select(F.col("node").alias("child"), F.col("child").alias("next"), *(F.col(c).alias(f"more_{c}") for c in ("leaves", "saved")))
        halved = links.join(then, "child", "left").select(
            "node",
            F.coalesce("next", "child").alias("child"),
            *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")),
        )
        links = materialise(_in_tasks(halved, n_links), f"expanded-{step}")
    ends = known.select(F.col("node").alias("child"), *(F.col(c).alias(f"more_{c}") for c in ("leaves", "saved")))
    expanded = links.join(ends, "child").select("node", *((F.col(c) + F.col(f"more_{c}")).alias(c) for c in ("leaves", "saved")))
    return known.unionByName(expanded)


def _folded(batches) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the runs of each node, which come in order; one digest is held at a time."""
    current, digest = None, None
    for batch in batches:
        out: list[tuple[int, int, str]] = []
        for a, b, text in zip(*(c.to_pylist() for c in batch.columns[:3])):
            if (a, b) != current:
                if current is not None:
                    out.append((*current, digest.hexdigest()))
                current, digest = (a, b), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
        if out:
            yield _digests(out)
    if current is not None:
        yield _digests([(*current, digest.hexdigest())])


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    a, b, text = zip(*rows)
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(text)], ["a", "b", "ends_sha256"])


def end_digests(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the ids of the conversations that end there, ascending, comma-joined.

    Ids meet in runs of 2 ** RUN_BITS consecutive ids, however many a node has; a node with several runs
    has them folded in order by a stream that holds one run.
    """
    ended = paths.where("ends").select("node", "conv_id", F.shiftright("conv_id", RUN_BITS).alias("run"))
    ids = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")))
    runs = materialise(ended.groupBy("node", "run").agg(ids.alias("ids")), "ends")
    count = runs.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("ids").alias("ids"))
    single = count.where(F.col("n") == 1).select("node", F.sha2("ids", 256).alias("ends_sha256"))
    many = runs.join(count.where(F.col("n") > 1).select("node"), "node", "left_semi")
    streamed = many.select(F.col("node.a").alias("a"), F.col("node.b").alias("b"), "ids", "run").repartition("a", "b").sortWithinPartitions("a", "b", "run")
    folded = streamed.select("a", "b", "ids").mapInArrow(_folded, "a bigint, b bigint, ends_sha256 string")
    return single.unionByName(folded.select(F.struct("a", "b").alias("node"), "ends_sha256"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns of the rebuilt conversations.

    Columns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    A null role or text is empty; a null turn comes first; rows with equal turns are ordered by role and
    text, and repeated rows are turns of their own. Rows without conv_id are left out; an empty table
    has no nodes, not even a root. Texts of any length are hashed once. Other columns are not read.
    """
    prepared(turns.sparkSession)
    paths = materialise(prefixes(*rebuilt(turns)), "prefixes")
    trie = nodes_of(paths)
    totals = subtree_totals(trie)
    parents = trie.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = end_digests(paths)
    return (
        trie.join(totals, "node")
        .join(ends, "node", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
