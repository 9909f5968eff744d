"""Chat formatting of reply trees.

Messages point to the message they answer.  Root-to-leaf paths come from iterative self-joins with
doubling jumps: round k joins each leaf's known ancestors to those 2**k further up, so a path of
any depth takes a logarithm of rounds and each (leaf, ancestor) pair is made once.  Branches are ranked by
their mean score, and each chosen path is formatted as one conversation:

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n ...

"<", backslashes, "|" in a text gains one backslash, so no control string survives in a text and the
original comes back exactly.  A role's newline is written <|n|>.  The loss mask is the list of
code-point spans of the assistants' texts in the output.

Cases: null text or role is the empty string; a null conv_id is a conversation of its own; an empty table gives no rows; messages on a cycle or
below a missing parent have no root and make no path; ties of rank go to the smaller leaf; repeated rows
of a turn are turns of their own, ordered by role and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Rows (four numbers each) of chosen paths that are broadcast; more meet the texts in a shuffled join.
BROADCAST_ROWS = 1_000_000
START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|n|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def linear(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) as trees with one branch."""
    role, text = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = rows.select("conv_id", "turn", role, text).withColumn("node", F.row_number().over(order).cast("long"))
    return placed.select("conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame) -> DataFrame:
    """(conv_id, leaf, node, up): every ancestor of every leaf whose path reaches a root; up is 0 at the leaf."""
    jump = materialize(messages.select("conv_id", "node", "parent"), "tree-jump")
    parents = jump.filter("parent is not null").select("conv_id", F.col("parent").alias("node")).distinct()
    found = materialize(jump.join(parents, ["conv_id", "node"], "left_anti").select("conv_id", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")), "tree-paths")
    roots = jump.filter("parent is null").select("conv_id", "node")
    step, most = 1, max(jump.count(), 1)
    while step < 2 * most and not jump.filter("parent is not null").isEmpty():
        far = jump.filter("parent is not null")
        more = found.join(far, ["conv_id", "node"]).select("conv_id", "leaf", F.col("parent").alias("node"), (F.col("up") + step).alias("up"))
        found = materialize(found.union(more), "tree-paths")
        onward = far.select("conv_id", F.col("node").alias("parent"), F.col("parent").alias("next"))
        jump = materialize(far.join(onward, ["conv_id", "parent"]).select("conv_id", "node", F.col("next").alias("parent")), "tree-jump")
        step *= 2
    whole = found.join(roots, ["conv_id", "node"], "left_semi").select("conv_id", "leaf").distinct()
    return found.join(whole, ["conv_id", "leaf"], "left_semi")


def format_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv_id, leaf, branch, formatted, mask): the best ``branches`` paths of each conversation."""
    # A struct of one field, so that a null conv_id meets itself in joins.
    messages = messages.select(F.struct("conv_id").alias("conv_id"), "node", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "score")
    messages = materialize(messages, "tree-messages")
    # Branches are ranked by keys and scores; texts meet the chosen ones alone.
    told = materialize(paths(messages).join(messages.select("conv_id", "node", "score"), ["conv_id", "node"]), "tree-told")
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("score"), "leaf"))
    ranked = told.groupBy("conv_id", "leaf").agg(F.avg("score").alias("score")).withColumn("branch", rank)
    best = materialize(told.drop("score").join(ranked.filter(F.col("branch") <= branches).drop("score"), ["conv_id", "leaf"]), "tree-chosen")
    best = F.broadcast(best) if best.count() <= BROADCAST_ROWS else best
    turn = F.struct((-F.col("up")).alias("at"), "role", "text")
    said = messages.select("conv_id", "node", "role", "text").join(best, ["conv_id", "node"])
    chosen = said.groupBy("conv_id", "leaf", "branch").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def parts(t: Column) -> Column:
        head = F.concat(F.lit(START), F.regexp_replace(escape(t["role"]), "\n", NEWLINE), F.lit("\n"))
        return F.struct(head.alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("learn"))

    pieces = chosen.select("conv_id", "leaf", "branch", F.transform("turns", parts).alias("pieces"))
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))), "")
    size = lambda p: F.length(p["head"]) + F.length(p["body"]) + len(END) + 1
    mask = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + size(p)).alias("at"),
            F.when(p["learn"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).alias("length"))))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return pieces.select("conv_id.conv_id", "leaf", "branch", formatted.alias("formatted"), mask.alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns array<role, text>, learned string) parsed from the output alone."""
    whole = F.filter(F.split("formatted", "<\\|im_end\\|>\n"), lambda x: x != "")

    def turn(x: Column) -> Column:
        rest = F.substr(x, F.lit(len(START) + 1))
        at = F.instr(rest, "\n")
        role = unescape(F.replace(F.substr(rest, F.lit(1), at - 1), F.lit(NEWLINE), F.lit("\n")))
        return F.struct(role.alias("role"), unescape(F.substr(rest, at + 1)).alias("text"))

    learned = F.array_join(F.transform("mask", lambda m: unescape(F.substr(F.col("formatted"), m["start"] + 1, m["length"]))), "")
    return formatted.select("conv_id", "leaf", "branch", "formatted", F.transform(whole, turn).alias("turns"), learned.alias("learned"))


def digests(messages: DataFrame) -> DataFrame:
    back = read_back(format_paths(messages))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS esc FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(12 + length(role) + 1 + length(esc) + 10 + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
