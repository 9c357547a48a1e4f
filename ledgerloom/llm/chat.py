"""Reply trees to conversations, with DataFrame functions.

A message has a tree, a node and a parent.  Ancestors are found by iterative self-joins that double their reach
(1, 2, 4, ... messages up), so a path of n messages takes log2(n) joins and no row grows with its path.  Leaves
are ranked within their tree by the summed score of their path; the same ancestor tables, read from the
longest reach down, enumerate the messages of the chosen root-to-leaf paths.  Each path becomes one text.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per message.  Control strings inside a text get a backslash
after their first character, and those that look escaped get one more, so escaping is reversible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.scale import durable

START, END = "<|im_start|>", "<|im_end|>"
_CONTROLS = r"\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_CONTROLS})", r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)\\({_CONTROLS})", r"$1$2$3")


def _role_out(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """``tree, leaf, rank, score, depth, node`` of the ``top`` best root-to-leaf paths of each tree.

    ``messages`` has ``tree, node, parent, score`` with unique non-null ``(tree, node)``.  A message whose
    parent is not in its tree is a root; messages on a cycle lead to no root and are on no path.  Paths rank by
    summed score (null: 0), then by leaf.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("sum"))
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    # far: the ancestor at this reach; sum and steps: from the message up to, without, that ancestor.
    reach = durable(
        nodes.join(known, ["tree", "parent"], "left")
        .select("tree", "node", F.expr("if(known, parent, null)").alias("far"), "sum", F.lit(1).cast("long").alias("steps"))
    )
    levels, limit = [reach], messages.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    while 1 << (len(levels) - 1) < limit and not levels[-1].where("far is not null").isEmpty():
        up = levels[-1].select(
            "tree", F.col("node").alias("far"), F.col("far").alias("further"), F.col("sum").alias("more"),
            F.col("steps").alias("on"),
        )
        levels.append(durable(
            levels[-1].join(up, ["tree", "far"], "left").select(
                "tree", "node", F.col("further").alias("far"), (F.col("sum") + F.coalesce("more", F.lit(0.0))).alias("sum"),
                (F.col("steps") + F.coalesce("on", F.lit(0))).alias("steps"),
            )
        ))
    parents = reach.select("tree", F.col("far").alias("node")).where("node is not null").distinct()
    leaves = levels[-1].where("far is null").join(parents, ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("sum"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    found = durable(
        chosen.select("tree", F.col("node").alias("leaf"), "rank", F.col("sum").alias("score"),
                      F.col("steps").alias("depth"), "node")
    )
    for k in reversed(range(len(levels))):
        up = levels[k].where("far is not null").select("tree", "node", "far")
        above = found.join(up, ["tree", "node"]).select(
            "tree", "leaf", "rank", "score", (F.col("depth") - (1 << k)).alias("depth"), F.col("far").alias("node")
        )
        found = durable(found.union(above))
    return found


def format_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """One row per chosen path: ``tree, leaf, rank, score, n_turns, formatted, loss_spans``.

    ``loss_spans`` are the code points (start, end) of assistant texts in ``formatted``.  Null roles and texts
    are empty.  A conversation is one row, so its messages meet in one group by nature.
    """
    texts = messages.select(
        "tree", "node", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = paths(messages, top).join(texts, ["tree", "node"]).select(
        "tree", "leaf", "rank", "score", "depth", "role",
        F.concat(F.lit(START), _role_out(F.col("role")), F.lit("\n")).alias("head"), escape(F.col("text")).alias("body"),
    )
    turn = F.concat("head", "body", F.lit(END + "\n"))
    so_far = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("turn", turn).withColumn(
        "start", F.coalesce(F.sum(F.length("turn").cast("long")).over(so_far), F.lit(0)) + F.length("head")
    )
    span = F.when(F.col("role") == "assistant", F.struct("start", (F.col("start") + F.length("body")).alias("end")))
    turns = F.sort_array(F.collect_list(F.struct("depth", "turn", span.alias("span"))))
    return rows.groupBy("tree", "leaf", "rank", "score").agg(turns.alias("turns")).select(
        "tree", "leaf", "rank", "score", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``loss_text``, both parsed from ``formatted`` and ``loss_spans``."""
    parts = F.split("formatted", r"<\|im_end\|>\n", -1)
    parts = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))

    def parse(part: Column) -> Column:
        inner = F.substr(part, F.lit(len(START) + 1))
        cut = F.instr(inner, "\n")
        return F.struct(
            _role_in(F.substr(inner, F.lit(1), cut - 1)).alias("role"), unescape(F.substr(inner, cut + 1)).alias("text")
        )

    masked = F.transform(
        "loss_spans",
        lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )
    return formatted.withColumn("turns", F.transform(parts, parse)).withColumn("loss_text", F.array_join(masked, ""))


def reply_chains(conversations: DataFrame) -> DataFrame:
    """Linear conversations as reply trees: each row answers the one before by turn, role and text.

    Rows that repeat a turn stay and follow one another; a null ``conv_id`` is a conversation of its own.
    """
    tree = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("null"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order))
    return rows.select(
        tree.alias("tree"), F.col("conv_id").cast("long").alias("conv_id"), F.col("node").cast("long").alias("node"),
        F.when(F.col("node") > 1, F.col("node") - 1).cast("long").alias("parent"),
        F.lit(None).cast("double").alias("score"), "role", "text",
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Every conversation of ``conv_id, turn, role, text`` as one formatted row, with what is read back from it."""
    rows = durable(reply_chains(conversations))
    ids = rows.where("node = 1").select("tree", "conv_id")
    return read_back(format_paths(rows)).join(ids, "tree")
