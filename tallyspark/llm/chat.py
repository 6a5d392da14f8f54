"""Chat formatting: typed content parts, flattened by one visitor into ordered placeholders, under a reversible template.

A turn's content is an array of parts (kind, text, ref, units). The visitor turns a text part into its escaped text and any other part
into a placeholder `<|kind:n|>` whose number counts the attachments of the turn, records the attachment's reference, and adds the tokens
that it stands for. A plain text is one text part. The template is

    <|im_start|>ROLE \\n TEXT <|im_end|>\\n        (without the blanks)

Control strings cannot come from a text: `\\` becomes `\\\\` and `<|` becomes `<\\|`. After escaping, `<` followed by exactly one
backslash and `|` can only stem from `<|`, so both steps undo each other. Newlines in a role are escaped too, as `\\n`.
The loss mask is a list of runs (code points, counted or not) over the formatted text; assistant texts count.

Nulls and odd input: a null role or text is empty; a null or unknown kind is a document; null units stand for no token; rows of a null
conv_id form one conversation; rows with the same turn are ordered by role and text; an empty table gives an empty result; other columns
are not read. One conversation's string is put together in one task, as its digest must be; its turns are formatted before that.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens for one unit of an attachment: image patches, audio seconds, document pages.
TOKENS_PER_UNIT = {"image": 1, "audio": 25, "document": 512}
PART = "array<struct<kind:string,text:string,ref:string,units:bigint>>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    """Pairs of backslashes are hidden as `<|`, which no escaped role holds, while the other two escapes are undone."""
    hidden = F.replace(F.replace(role, F.lit("\\\\"), F.lit("<|")), F.lit("\\n"), F.lit("\n"))
    return F.array_join(F.transform(F.split(hidden, r"<\|", -1), lambda piece: F.replace(piece, F.lit("<\\|"), F.lit("<|"))), "\\")


def text_parts(text: Column) -> Column:
    """A plain text as typed content."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("bigint").alias("units"))).cast(PART)


def visit_parts(parts: Column) -> Column:
    """struct(body, attachments, expanded_tokens, last): one pass over the parts, in order."""
    found = "array<struct<place:int,kind:string,ref:string,tokens:bigint>>"
    begin = F.struct(F.lit("").alias("body"), F.array().cast(found).alias("attachments"), F.lit(0).cast("bigint").alias("expanded_tokens"))

    def step(seen, part):
        kind = F.when(part["kind"].isin("text", *TOKENS_PER_UNIT), part["kind"]).otherwise("document")
        place = (F.size(seen["attachments"]) + 1).cast("int")
        each = F.coalesce(*[F.when(kind == k, F.lit(n)) for k, n in TOKENS_PER_UNIT.items()], F.lit(0)).cast("bigint")
        tokens = F.coalesce(part["units"] * each, F.lit(0).cast("bigint"))
        mark = F.concat(F.lit("<|"), kind, F.lit(":"), place.cast("string"), F.lit("|>"))
        is_text = kind == "text"
        one = F.array(F.struct(place.alias("place"), kind.alias("kind"), part["ref"].alias("ref"), tokens.alias("tokens"))).cast(found)
        return F.struct(
            F.concat(seen["body"], F.when(is_text, escape(F.coalesce(part["text"], F.lit("")))).otherwise(mark)).alias("body"),
            F.when(is_text, seen["attachments"]).otherwise(F.concat(seen["attachments"], one)).alias("attachments"),
            (seen["expanded_tokens"] + F.when(is_text, F.lit(0).cast("bigint")).otherwise(tokens)).alias("expanded_tokens"))

    return F.aggregate(F.coalesce(parts, F.array().cast(PART)), begin, step)


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, mask_runs, attachments, expanded_tokens) from (conv_id, turn, role, parts)."""
    visited = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), visit_parts(F.col("parts")).alias("v"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    one = visited.select("conv_id", F.struct(
        F.col("turn").isNull().alias("no_turn"), "turn", "role", F.col("v.body").alias("body"), head.alias("head"),
        F.col("v.attachments").alias("attachments"), F.col("v.expanded_tokens").alias("expanded_tokens")).alias("t"))
    chats = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))

    def runs(t):
        return F.array(F.struct(F.length(t["head"]).cast("bigint").alias("chars"), F.lit(False).alias("loss")),
                       F.struct(F.length(t["body"]).cast("bigint").alias("chars"), (t["role"] == "assistant").alias("loss")),
                       F.struct(F.lit(len(END)).cast("bigint").alias("chars"), F.lit(False).alias("loss")))

    return chats.select(
        "conv_id", F.size("ts").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.flatten(F.transform("ts", runs)).alias("mask_runs"),
        F.flatten(F.transform("ts", lambda t: t["attachments"])).alias("attachments"),
        F.aggregate(F.transform("ts", lambda t: t["expanded_tokens"]), F.lit(0).cast("bigint"), lambda a, b: a + b).alias("expanded_tokens"))


RUNS_PER_TURN = 3


def under_mask(formatted: Column, mask_runs: Column) -> Column:
    """array<string>: the unescaped texts of the runs that count, cut out of the formatted string by the mask alone.

    A turn's runs are cut out of that turn, so that a long conversation is walked once; runs that do not fill their turn exactly are an error.
    """
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda p, i: i > 0)

    def cut(piece, i):
        whole = F.concat(F.lit(START), piece)
        runs = [F.element_at(mask_runs, i * RUNS_PER_TURN + (k + 1)) for k in range(RUNS_PER_TURN)]
        begins = [sum((r["chars"] for r in runs[:k]), F.lit(0).cast("bigint")) for k in range(RUNS_PER_TURN + 1)]
        texts = [F.when(r["loss"], unescape(F.substr(whole, (b + 1).cast("int"), r["chars"].cast("int")))) for r, b in zip(runs, begins)]
        fits = begins[-1] == F.length(whole)
        return F.when(fits, F.filter(F.array(*texts), lambda t: t.isNotNull())).otherwise(F.raise_error(F.lit("the mask's runs do not fill their turns")).cast("array<string>"))

    return F.when(F.size(pieces) * RUNS_PER_TURN == F.size(mask_runs), F.flatten(F.transform(pieces, cut))).otherwise(
        F.raise_error(F.lit("the mask has runs of other turns")).cast("array<string>"))


def read_back(formatted: Column) -> Column:
    """array<struct<role, body>> from a formatted string; body is still escaped."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda p, i: i > 0)

    def turn(piece):
        role = F.substring_index(piece, "\n", 1)
        body = F.substr(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - F.lit(len(END)))
        return F.struct(unescape_role(role).alias("role"), body.alias("body"))

    return F.transform(pieces, turn)
