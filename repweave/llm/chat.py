"""Chat formatting (operator 5), relational: Spark expressions only.

The turns of a conversation are collected as structs and sorted, adjacent turns of one role
are merged into a block by array slices, and blocks are concatenated to one string:

    <|im_start|>role\\n text [<|im_sep|> text]... <|im_end|>\\n

Inside texts and roles every ``<``, backslashes, ``|`` gets one backslash more, so no
control string can come from a text, and taking one backslash away gives the text back.
In roles ``%`` and line ends are written ``%25`` and ``%0A``, a NULL role ``%N``.

The loss mask is run-length coded: ``loss_runs`` holds (chars, in_loss) in order and covers the whole
string; under the mask stands each assistant text. ``read_back`` takes turns and loss text
from the formatted string alone.

A conversation is one output row, so its turns meet in one row by definition; a conversation
costs time in proportion to its length. Defined cases: NULL text is empty; turns that tie
are ordered by role, then text; repeated rows stay; rows with NULL id form one conversation; an
empty table gives no rows; columns other than the four named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNT_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def write_role(role: Column) -> Column:
    plain = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escape(F.coalesce(plain, F.lit("%N")))


def read_role(written: Column) -> Column:
    plain = unescape(written)
    return F.when(plain != "%N", F.replace(F.replace(plain, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", learnt_role: str = LEARNT_ROLE) -> DataFrame:
    """(id, n_blocks, formatted, loss_runs), one row per conversation."""
    rows = turns.select(
        F.col(id_col).alias("__id"),
        F.struct(F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
                 F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).alias("t"))
    one = rows.groupBy("__id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    # where a block starts: the first turn, and each of another role than the turn before
    heads = F.filter(F.sequence(F.lit(0), F.size("ts") - 1),
                     lambda i: (i == 0) | ~F.get("ts", i)["role"].eqNullSafe(F.get("ts", i - 1)["role"]))
    one = one.withColumn("heads", heads)
    blocks = F.transform("heads", lambda h, k: F.struct(
        F.get("ts", h)["role"].alias("role"),
        F.transform(F.slice("ts", h + 1, F.coalesce(F.get("heads", k + 1), F.size("ts")) - h),
                    lambda t: escape(t["text"])).alias("texts")))
    one = one.withColumn("blocks", blocks)
    head = lambda b: F.concat(F.lit(START), write_role(b["role"]), F.lit("\n"))
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(
        head(b), F.array_join(b["texts"], SEP), F.lit(END + "\n"))), "")
    run = lambda n, loss: F.struct(n.cast("long").alias("chars"), loss.alias("in_loss"))
    # runs of a block: its head with no text, then each text and what stands after it
    runs = F.flatten(F.transform("blocks", lambda b: F.concat(
        F.array(run(F.char_length(head(b)), F.lit(False))),
        F.flatten(F.transform(b["texts"], lambda x, i: F.array(
            run(F.char_length(x), F.coalesce(b["role"] == learnt_role, F.lit(False))),
            run(F.when(i + 1 < F.size(b["texts"]), len(SEP)).otherwise(len(END) + 1), F.lit(False))))))))
    return one.select(F.col("__id").alias(id_col), F.size("blocks").cast("long").alias("n_blocks"),
                      formatted.alias("formatted"), runs.alias("loss_runs"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted string: array of (role, text)."""
    parts = F.split(formatted, START.replace("|", r"\|"))
    blocks = F.slice(parts, F.lit(2), F.size(parts))
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.substring_index(F.substr(b, F.locate("\n", b) + 1), END, 1), SEP.replace("|", r"\|")),
        lambda x: F.struct(read_role(F.substring_index(b, "\n", 1)).alias("role"), unescape(x).alias("text")))))


def under_mask(formatted: Column, runs: Column) -> Column:
    """The text under the loss mask, unescaped: each masked run is cut out of the string by its running offset."""
    spans = F.aggregate(
        runs, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<at:bigint,chars:bigint>>").alias("spans")),
        lambda acc, r: F.struct((acc["at"] + r["chars"]).alias("at"), F.when(r["in_loss"], F.array_append(
            acc["spans"], F.struct(acc["at"].alias("at"), r["chars"].alias("chars")))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["at"] + 1).cast("int"), s["chars"].cast("int")))), "")


def digests(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the formatted strings hold, read back from them: the turns, and the text under the loss mask."""
    turns = formatted.withColumn("turns", read_back(F.col("formatted")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(
        F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.withColumn("loss", under_mask(F.col("formatted"), F.col("loss_runs"))).select(
        id_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "n_blocks")
