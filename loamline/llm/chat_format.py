"""Chat formatting: conversations of typed content parts into one training string each.

Method: a visitor flattens a turn's parts (text, image, audio, document) in order. Text is escaped;
any other part becomes a numbered placeholder, and the turn records its attachment: placeholder,
kind, reference and the number of tokens that it expands to. The template writes ``<s>``, the role,
a line feed, the flattened text and ``</s>`` for each turn. Everything is a DataFrame expression.

Escaping puts a backslash before every backslash and behind the first character of every control
string, so no control string survives inside a text, and taking each backslash away again gives the
text back. Neighbouring text parts are joined before, so none survives that is split over parts. A role's line feeds and per cent signs are percent-encoded.

The loss mask is a list of spans of the formatted string (code points, end exclusive), one for each
assistant turn, over its flattened text alone.

Defined results: null text is empty; a null role is the empty role; a null conv_id is a conversation
of its own; turns go by turn (null first), and ties by role and text; repeated rows are turns of
their own; unknown part kinds are treated as documents; empty tables give no conversations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.llm.common import pick

# The control strings of the template and of its kin.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
PLACEHOLDER_KINDS = ["image", "audio", "document"]
OPEN, CLOSE = "<s>", "</s>"
_ESCAPES = r"(\\)|(<)(/?s>|</?SYS>>)|(\[)(/?INST\]|/?(?:image|audio|document) [0-9]+\])"

PATCH = 14
TOKENS_A_SECOND = 25
TOKENS_A_PAGE = 512

PARTS = "array<struct<kind:string,text:string,reference:string,width:int,height:int,seconds:double,pages:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPES, r"$2$4\\$1$3$5")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role_out(role: Column) -> Column:
    return escape(F.replace(F.replace(F.coalesce(role, F.lit("")), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def text_parts(text: Column) -> Column:
    """A plain text as one typed part."""
    nothing = {"reference": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()]))


def expanded_tokens(part: Column) -> Column:
    """Tokens that an attachment takes: image patches, audio frames, pages; one at least."""
    image = F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * TOKENS_A_SECOND)
    pages = F.coalesce(part["pages"], F.lit(1)) * TOKENS_A_PAGE
    return F.greatest(F.when(part["kind"] == "image", image).when(part["kind"] == "audio", audio).otherwise(pages).cast("long"), F.lit(1).cast("long"))


def _kind(part: Column) -> Column:
    return F.when(part["kind"].isin("text", *PLACEHOLDER_KINDS), part["kind"]).otherwise(F.lit("document"))


def visited(parts: Column) -> Column:
    """flat (the placeholders and escaped texts in order) and attachments of a turn's parts.

    Placeholders are numbered within the turn, from 1, over all kinds.
    """
    others = F.filter(parts, lambda p: _kind(p) != "text")
    marked = F.transform(others, lambda p, i: F.struct((i + 1).alias("n"), _kind(p).alias("kind"), p["reference"].alias("reference"), expanded_tokens(p).alias("tokens")))
    return let(F.struct(parts.alias("parts"), marked.alias("marked")), _flattened)


def _flattened(x: Column) -> Column:
    """What stands between attachments is one text; escaped texts and placeholders take turns."""
    at = F.filter(F.transform(x["parts"], lambda p, i: F.when(_kind(p) != "text", i + 1)), lambda i: i.isNotNull())
    edges = F.concat(F.array(F.lit(0)), at, F.array(F.size(x["parts"]) + 1))
    shown = F.transform(x["marked"], lambda m: F.concat(F.lit("["), m["kind"], F.lit(" "), m["n"].cast("string"), F.lit("]")))
    between = lambda a, b: F.array_join(F.transform(F.slice(x["parts"], a + 1, b - a - 1), lambda p: F.coalesce(p["text"], F.lit(""))), "")
    flat = let(edges, lambda e: F.transform(F.slice(e, 2, F.size(e) - 1), lambda end, k: F.concat(escape(between(F.get(e, k), end)), F.coalesce(F.get(shown, k), F.lit("")))))
    return F.struct(F.array_join(flat, "").alias("flat"), x["marked"].alias("attachments"))


def format_parts(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts") -> DataFrame:
    """One row a conversation: conv_id, n_turns, formatted, loss_mask, attachments, n_tokens_attached.

    attachments hold the turn's number (from 0), the placeholder's number, kind, reference, tokens.
    """
    rows = pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, parts=parts_col)
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), visited(F.coalesce(F.col("parts"), F.expr(f"cast(array() as {PARTS})"))).alias("seen"))
    # texts are escaped where they are read, and travel once; what follows is put together behind the shuffle
    rows = rows.select("conv_id", "turn", "role", "seen.flat", "seen.attachments").repartition("conv_id")
    rows = rows.withColumn("piece", F.concat(F.lit(OPEN), _role_out(F.col("role")), F.lit("\n"), "flat", F.lit(CLOSE)))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", unescape(F.col("flat")))
    rows = rows.withColumn("n", F.row_number().over(order)).withColumn("end", F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    stop = F.col("end") - len(CLOSE)
    span = F.when(F.col("role") == "assistant", F.struct((stop - F.length("flat")).alias("start"), stop.alias("end")))
    attached = F.transform("attachments", lambda a: F.struct((F.col("n") - 1).alias("turn"), a["n"].alias("n"), a["kind"].alias("kind"), a["reference"].alias("reference"), a["tokens"].alias("tokens")))
    rows = rows.select("conv_id", F.struct("n", "piece", span.alias("span"), attached.alias("attached")).alias("row"))
    out = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    out = out.select("conv_id", F.size("rows").cast("long").alias("n_turns"), F.array_join("rows.piece", "").alias("formatted"), F.array_compact("rows.span").alias("loss_mask"), F.flatten("rows.attached").alias("attachments"))
    return out.withColumn("n_tokens_attached", F.aggregate("attachments", F.lit(0).cast("long"), lambda acc, a: acc + a["tokens"]))


def format_chats(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """As :func:`format_parts`, for turns of plain text."""
    rows = pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    return format_parts(rows.select("conv_id", "turn", "role", text_parts(F.col("text")).alias("parts")))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text; placeholders stay), loss_text, from formatted and loss_mask alone."""
    pieces = F.slice(F.split("formatted", CLOSE, -1), 1, F.size(F.split("formatted", CLOSE, -1)) - 1)
    at = lambda p: F.locate("\n", p)
    turns = F.transform(pieces, lambda p: F.struct(_role_in(F.substring(p, F.lit(len(OPEN) + 1), at(p) - len(OPEN) - 1)).alias("role"), unescape(F.substring(p, at(p) + 1, F.length(p))).alias("text")))
    loss = F.array_join(F.transform("loss_mask", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    return formatted.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss_text"))


def report(turns: DataFrame) -> DataFrame:
    """The contract's columns, read back from the formatted strings."""
    back = read_back(format_chats(turns))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1: both turns say control strings."""
    said = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '(\\)|(<)(/?s>|</?SYS>>)|(\[)(/?INST\]|/?(?:image|audio|document) [0-9]+\])', '\2\4\\\1\3\5', 'g'))
    + length(regexp_replace(text, '(\\)|(<)(/?s>|</?SYS>>)|(\[)(/?INST\]|/?(?:image|audio|document) [0-9]+\])', '\2\4\\\1\3\5', 'g')) + 8 AS size
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
