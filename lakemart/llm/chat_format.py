"""Chat formatting: paths of reply trees, ranked and written as conversations.

Replies form trees.  Iterative self-joins double the reach of each node's jump
to an ancestor, so a tree of depth d takes log2(d) joins; on the way they add up
scores.  Leaves are the ends of branches; branches are ranked by mean score; the
chosen ones are spelled out by following the same jumps, and each is written as
one conversation.

Template: ``### role: text </turn>`` and a line feed for each turn.  Inside
texts and roles the control strings and the escape sign are replaced (``\\b`` for
the sign, ``\\h`` for ###, ``\\t`` for </turn>, ``\\c`` for a colon in a role), so
that no control string is left and the replacement can be undone.

NULL text, role: empty.  NULL tree: a tree of its own.  A parent that is not
there makes its child a root.  Rows of one turn are ordered by role and text;
repeated rows are turns of their own.  Empty table: no rows.  Further columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import stored

MARK, END, SIGN = "### ", "</turn>\n", "\\"
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
MAX_ROUNDS = 40  # paths of up to 2^40 turns; more can only be a circle


def _replaced(value: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    for old, new in pairs:
        value = F.replace(value, F.lit(old), F.lit(new))
    return value


def escape(value: Column) -> Column:
    return _replaced(value, ESCAPES)


def unescape(value: Column) -> Column:
    return _replaced(value, tuple((new, old) for old, new in reversed(ESCAPES)))


def escape_role(value: Column) -> Column:
    return _replaced(escape(value), ((":", "\\c"),))


def unescape_role(value: Column) -> Column:
    return unescape(_replaced(value, (("\\c", ":"),)))


def chains(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations as trees of one branch: each turn answers the one before."""
    clean = turns.select(
        F.col(conv).alias("tree"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return clean.withColumn("node", F.row_number().over(order).cast("long")).select(
        "tree",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def _jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Per round the ancestors 2^k steps up; and each node's depth and score total."""
    ids = nodes.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"))
    there = ids.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    state = ids.join(there, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("n")), "left").select(
        "tree", "node", F.col("n").alias("up"), F.lit(1).cast("long").alias("depth"), "total"
    )
    state = stored(state, "chat-jump")
    rounds = []
    for _ in range(MAX_ROUNDS):
        moving = state.where(F.col("up").isNotNull())
        if moving.isEmpty():
            return rounds, state
        rounds.append(moving.select("tree", "node", "up"))
        far = state.select(
            F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("f_up"), F.col("depth").alias("f_depth"), F.col("total").alias("f_total")
        )
        joined = state.join(far, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n")), "left")
        state = stored(
            joined.select(
                "tree",
                "node",
                F.col("f_up").alias("up"),
                (F.col("depth") + F.coalesce(F.col("f_depth"), F.lit(0))).alias("depth"),
                (F.col("total") + F.coalesce(F.col("f_total"), F.lit(0.0))).alias("total"),
            ),
            "chat-jump",
        )
    raise ValueError("the replies run in a circle")


def paths(nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree, leaf, rank, at, node): the chosen root-to-leaf paths, ``at`` counted back from the leaf."""
    rounds, state = _jumps(nodes)
    parents = nodes.select(F.col("tree").alias("t"), F.col("parent").alias("p")).where(F.col("p").isNotNull())
    leaves = state.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("p")), "left_anti")
    best = Window.partitionBy("tree").orderBy((F.col("total") / F.col("depth")).desc(), F.col("depth").desc(), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(best))
    if branches is not None:
        ranked = ranked.where(F.col("rank") <= branches)
    found = ranked.select("tree", F.col("node").alias("leaf"), "rank", F.lit(0).cast("long").alias("at"), "node")
    # Reach 2^k steps from 2^k known places, nearest jumps first.
    for k, jump in enumerate(rounds):
        step = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        joined = found.join(step, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left")
        here = F.struct("at", "node")
        above = F.struct((F.col("at") + (1 << k)).alias("at"), F.col("up").alias("node"))
        both = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, above))
        found = joined.select("tree", "leaf", "rank", F.explode(both).alias("x")).select("tree", "leaf", "rank", "x.at", "x.node")
    return found


def format_paths(nodes: DataFrame, branches: int | None = None, learned: str = "assistant") -> DataFrame:
    """One conversation per chosen path: (tree, leaf, rank, formatted, loss_spans).

    ``loss_spans`` are (start, length) in code points, counted from 1, of the
    texts of the ``learned`` role as they stand in ``formatted``.
    """
    said = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    turns = paths(nodes, branches).join(said, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
    head = F.concat(F.lit(MARK), escape_role(F.coalesce("role", F.lit(""))), F.lit(": "))
    body = escape(F.coalesce("text", F.lit("")))
    written = turns.select(
        "tree", "leaf", "rank", "at", (F.col("role") == learned).alias("learned"), head.alias("head"), body.alias("body"),
    ).withColumn("turn", F.concat("head", "body", F.lit(" " + END)))
    order = Window.partitionBy("tree", "leaf").orderBy(F.col("at").desc())
    before = F.sum(F.length("turn").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.length("turn")
    placed = written.withColumn("start", before + F.length("head") + 1)
    span = F.when(F.col("learned"), F.struct(F.col("start"), F.length("body").cast("long").alias("length")))
    return (
        placed.groupBy("tree", "leaf", "rank")
        .agg(
            F.sort_array(F.collect_list(F.struct((-F.col("at")).alias("place"), "turn"))).alias("turns"),
            F.sort_array(F.collect_list(span)).alias("loss_spans"),
        )
        .select("tree", "leaf", "rank", F.array_join("turns.turn", "").alias("formatted"), "loss_spans")
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    parts = F.split(formatted, END)
    turns = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, ": ", 1)
        text = F.substring(part, F.length(role) + 3, F.length(part) - F.length(role) - 3)
        return F.struct(
            unescape_role(F.substring(role, F.lit(len(MARK) + 1), F.length(role))).alias("role"), unescape(text).alias("text")
        )

    return F.transform(turns, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"].cast("int"), s["length"].cast("int")))), ""
    )
