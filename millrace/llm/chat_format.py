"""Chat formatting with a grammar round trip (operator 7), DataFrame operations only.

Grammar of the formatted text (one string per conversation):

    conversation := turn*
    turn         := "[INST] " role mark? "\\n" content "</s>"     role other than assistant
                  | "[/INST] " role mark? "\\n" content "</s>"    role assistant
    mark         := "~"                                           content is escaped

A turn is first rendered as it is, reparsed by the deterministic parser and
compared with its source; turns that hold control strings or don't come back
identical are rendered escaped.  The whole conversation is then reparsed; if
any turn differs, all its turns are escaped, which cannot conflict.  Roles are
always escaped.  Escapes: ``\\`` -> ``\\b``, ``<`` -> ``\\l``, ``[`` -> ``\\o``, line
feed (roles) -> ``\\n``, ``~`` (roles) -> ``\\t``; decoding them in the reverse
order is unambiguous because every backslash is followed by its letter.

The loss mask covers assistant contents; ``spans`` gives each turn's content in
the formatted text (from, characters), its role and whether it is learned.

Defined results: null text and null role are empty; turns are ordered by turn
(null first), equal turns by role and text; repeated rows are turns of their
own.  A null conversation id is one conversation.  An empty table gives no
rows.  Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNED = "assistant"
END = "</s>"
#: Strings that steer chat models; texts that hold one are escaped.
CONTROLS = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|"]
_CONTENT = [("\\", "\\b"), ("<", "\\l"), ("[", "\\o")]
_ROLE = [*_CONTENT, ("\n", "\\n"), ("~", "\\t")]


def _escape(c: Column, table: list) -> Column:
    for plain, code in table:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def _unescape(c: Column, table: list) -> Column:
    for plain, code in reversed(table):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def render(role: Column, text: Column, escaped: Column) -> Column:
    """One turn as formatted text."""
    head = F.when(role == LEARNED, F.lit("[/INST] ")).otherwise(F.lit("[INST] "))
    return F.concat(head, _escape(role, _ROLE), F.when(escaped, F.lit("~")).otherwise(F.lit("")), F.lit("\n"),
                    F.when(escaped, _escape(text, _CONTENT)).otherwise(text), F.lit(END))


def parse(formatted: Column) -> Column:
    """Formatted text to turns (role, text, raw content, characters of the head), by splitting at turn ends."""
    segments = F.split(formatted, F.lit(END), -1)
    # what follows the last turn's end is empty
    segments = F.slice(segments, F.lit(1), F.size(segments) - 1)

    def turn(s: Column) -> Column:
        head = F.substring_index(s, "\n", 1)
        content = F.substr(s, F.char_length(head) + 2)
        label = F.regexp_replace(head, r"^\[/?INST\] ", "")
        marked = label.endswith("~")
        role = _unescape(F.when(marked, F.substr(label, F.lit(1), F.char_length(label) - 1)).otherwise(label), _ROLE)
        return F.struct(role.alias("role"), F.when(marked, _unescape(content, _CONTENT)).otherwise(content).alias("text"),
                        content.alias("content"), (F.char_length(head) + 1).alias("head"))

    return F.transform(segments, turn)


def _conflicts(role: Column, text: Column) -> Column:
    """Holds a control string, or doesn't come back from its own rendering."""
    held = F.lit(False)
    for s in CONTROLS:
        held = held | F.contains(text, F.lit(s))
    back = parse(render(role, text, F.lit(False)))
    same = (F.size(back) == 1) & (F.try_element_at(back, F.lit(1))["text"] == text) & (F.try_element_at(back, F.lit(1))["role"] == role)
    return held | ~F.coalesce(same, F.lit(False))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``spans``."""
    src = turns.select(turns[conv_col].alias("conv"), turns[turn_col].alias("turn"), F.coalesce(turns[role_col], F.lit("")).alias("role"),
                       F.coalesce(turns[text_col], F.lit("")).alias("text"))
    src = src.withColumn("escaped", _conflicts(F.col("role"), F.col("text")))
    one = F.struct("turn", "role", "text", render(F.col("role"), F.col("text"), F.col("escaped")).alias("shown"))
    conv = src.groupBy("conv").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    conv = conv.withColumn("formatted", F.array_join(F.col("turns.shown"), ""))
    back = parse(F.col("formatted"))
    wanted = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    same = F.transform(back, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))) == wanted
    safe = F.array_join(F.transform("turns", lambda t: render(t["role"], t["text"], F.lit(True))), "")
    conv = conv.select("conv", F.when(same, F.col("formatted")).otherwise(safe).alias("formatted"))
    return conv.select(F.col("conv").alias(conv_col), "formatted", spans(F.col("formatted")).alias("spans"))


def spans(formatted: Column) -> Column:
    """Content spans: characters from the end of the turn before (``skip``), length, role, learned."""
    return F.transform(parse(formatted), lambda t: F.struct(t["head"].alias("skip"), F.char_length(t["content"]).alias("length"),
                                                            t["role"].alias("role"), (t["role"] == LEARNED).alias("learned")))


def read_back(chats: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What the formatted text holds: turns and digests, by reparsing it."""
    turns = F.col("back")
    learned = F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == LEARNED), lambda t: t["text"]), "")
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (chats.select(conv_col, "formatted", parse(F.col("formatted")).alias("back")).withColumn("learned", learned)
            .select(conv_col, F.size(turns).cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                    F.char_length("learned").cast("bigint").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("bigint").alias("formatted_chars")))
