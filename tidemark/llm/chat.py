r"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is a list of parts: text, image, audio or document. A visitor
flattens them in order: text is escaped and stands as it is; an attachment
becomes a placeholder, and its reference, offset and expanded token count go to
the list of attachments. Turns are marked ``<|turn|>role<|text|>content<|end|>``.

Inside texts ``\`` becomes ``\\`` and ``<|`` becomes ``<\|``, also where one part
ends with ``<`` and the next begins with ``|``, so no content holds ``<|``: marks
can't be forged, and undoing both escapes gives the text back. In a reference
``|>`` becomes ``|\>`` too, so a placeholder ends where it says and typed parts
can be read back; text parts that follow each other are one then.

Nulls and edge cases: null texts, roles and references are empty; a null list of
parts is an empty content; parts of other types are kept as text; rows of one
turn number are ordered by role, then content; a null turn number comes first;
rows without conv_id form one conversation; an empty table gives an empty table;
other columns are ignored. A conversation is one row of the result, so it must
fit in a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

#: Expanded tokens: an image's tiles of 14 x 14 pixels in groups of four, an
#: audio's frames of 40 ms, a document's pages.
PIXELS, FRAMES_PER_SECOND, TOKENS_PER_PAGE = 28, 25, 512


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\([\\|>])", "$1")


def text_part(text: Column) -> Column:
    """A list of one text part."""
    null = lambda kind: F.lit(None).cast(kind)
    return F.array(F.struct(
        F.lit("text").alias("type"), text.alias("text"), null("string").alias("ref"), null("int").alias("width"),
        null("int").alias("height"), null("double").alias("seconds"), null("int").alias("pages")).cast(PART))


def expanded_tokens(p: Column) -> Column:
    """Tokens that a model spends on an attachment; 0 for text."""
    whole = lambda c: F.ceil(F.coalesce(c, F.lit(0))).cast("long")
    return (
        F.when(p["type"] == "image", whole(p["width"] / PIXELS) * whole(p["height"] / PIXELS))
        .when(p["type"] == "audio", whole(p["seconds"] * FRAMES_PER_SECOND))
        .when(p["type"] == "document", whole(p["pages"]) * TOKENS_PER_PAGE)
        .otherwise(F.lit(0).cast("long"))
    )


def is_attachment(p: Column) -> Column:
    return F.coalesce(p["type"].isin("image", "audio", "document"), F.lit(False))


def flatten(p: Column) -> Column:
    """What a part becomes in the formatted text."""
    ref = F.replace(escape(p["ref"]), F.lit("|>"), F.lit("|\\>"))
    mark = F.concat(F.lit("<|"), p["type"], F.lit(":"), ref, F.lit("|>"))
    return F.when(is_attachment(p), mark).otherwise(escape(p["text"]))


def joined(parts: Column) -> Column:
    """The parts' flattened forms in a row; a ``|`` that would meet the ``<`` of
    the part before it is escaped. Attachments neither end with ``<`` nor begin
    with ``|``."""
    full = F.filter(F.transform(parts, flatten), lambda x: x != "")
    pairs = F.arrays_zip(full.alias("part"), F.concat(F.array(F.lit("")), full).alias("before"))
    meet = lambda z: z["before"].endswith("<") & z["part"].startswith("|")
    # the last pair has no part: it is null and left out
    return F.array_join(F.transform(pairs, lambda z: F.concat(F.when(meet(z), "\\").otherwise(""), z["part"])), "")


def format_chats(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans, attachments, expanded_tokens`` from
    rows of ``conv_id, turn, role, parts``.

    loss_spans are the assistant contents as (start, length) in code points of
    the formatted text; attachments list (turn, part, type, ref, start, tokens).
    """
    role, parts = F.coalesce("role", F.lit("")), F.coalesce("parts", F.array().cast(f"array<{PART}>"))
    turns = messages.select(
        "conv_id", F.struct(
            "turn", role.alias("role"), joined(parts).alias("content"),
            parts.alias("parts")).alias("t"),
    ).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    head = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))
    one = lambda t: F.concat(head(t), t["content"], F.lit(END))
    shape = "array<struct<start:bigint,head:bigint,size:bigint>>"
    # each turn's place: a running sum of lengths
    laid = F.aggregate(
        "turns", F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(shape).alias("places")),
        lambda acc, t: F.struct(
            (acc["at"] + F.char_length(one(t))).cast("bigint").alias("at"),
            F.concat(acc["places"], F.array(F.struct(
                acc["at"].alias("start"), F.char_length(head(t)).cast("bigint").alias("head"),
                F.char_length(t["content"]).cast("bigint").alias("size")))).alias("places")))["places"]
    placed = turns.withColumn("places", laid).select(
        "conv_id", F.array_join(F.transform("turns", one), "").alias("formatted"),
        F.arrays_zip("turns", "places").alias("z"))
    spans = F.transform(
        F.filter("z", lambda z: z["turns"]["role"] == "assistant"),
        lambda z: F.struct((z["places"]["start"] + z["places"]["head"]).alias("start"), z["places"]["size"].alias("length")))

    def attached(z: Column, nth: Column) -> Column:
        ps = z["turns"]["parts"]
        before = lambda i: F.char_length(joined(F.slice(ps, F.lit(1), i)))
        rows = F.transform(ps, lambda p, i: F.struct(
            nth.alias("turn"), i.alias("part"), p["type"].alias("type"), F.coalesce(p["ref"], F.lit("")).alias("ref"),
            (z["places"]["start"] + z["places"]["head"] + before(i)).cast("bigint").alias("start"),
            expanded_tokens(p).alias("tokens"), is_attachment(p).alias("is")))
        return F.transform(F.filter(rows, lambda r: r["is"]), lambda r: r.dropFields("is"))

    found = F.flatten(F.transform("z", attached))
    return placed.select(
        "conv_id", "formatted", spans.alias("loss_spans"), found.alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate(
        "attachments", F.lit(0).cast("bigint"), lambda a, x: a + x["tokens"]))


def _turns(formatted: str) -> Column:
    """(role, content) of each turn, escaped as they stand."""
    whole = F.filter(F.split(formatted, r"<\|end\|>"), lambda x: x != "")
    return F.transform(whole, lambda x: F.split(F.substring_index(x, TURN, -1), r"<\|text\|>", 2))


def read_parts(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns`` back from the formatted text: a turn is its role and
    its parts as (type, value), the value a text or an attachment's reference."""
    kinds = r"<\|(?:image|audio|document):"

    def typed(x: Column) -> Column:
        found = x.rlike("^" + kinds)
        return F.struct(
            F.when(found, F.regexp_extract(x, r"^<\|(\w+):", 1)).otherwise("text").alias("type"),
            F.when(found, unescape(F.regexp_replace(x, rf"^{kinds}|\|>$", ""))).otherwise(unescape(x)).alias("value"))

    def put(parts: Column, p: Column) -> Column:
        """Append a part; a text goes on with a text before it."""
        last = F.element_at(parts, -1)
        both = F.struct(p["type"].alias("type"), F.concat(last["value"], p["value"]).alias("value"))
        text = (F.size(parts) > 0) & (last["type"] == "text") & (p["type"] == "text")
        return F.when(text, F.concat(F.slice(parts, F.lit(1), F.size(parts) - 1), F.array(both))).otherwise(
            F.concat(parts, F.array(p)))

    # a text may hold |>, so it may be cut there: its pieces are put together again,
    # before escapes are undone, as none of them ends inside one
    pieces = lambda c: F.filter(F.split(c, rf"(?={kinds})|(?<=\|>)"), lambda x: x != "")
    none = F.array().cast("array<struct<type:string,value:string>>")
    parts = lambda c: F.aggregate(F.transform(pieces(c), typed), none, put)
    turns = F.transform(_turns("formatted"), lambda t: F.struct(unescape(t[0]).alias("role"), parts(t[1]).alias("parts")))
    return formatted.select("conv_id", turns.alias("turns"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_text`` back from the formatted text and its spans;
    turns are (role, text) with escapes undone, placeholders left as they are."""
    turns = F.transform(_turns("formatted"), lambda x: F.struct(
        unescape(x[0]).alias("role"), unescape(x[1]).alias("text")))
    masked = F.transform("loss_spans", lambda s: unescape(
        F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))
