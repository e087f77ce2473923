r"""Chat formatting with a grammar round trip, in built-in functions only.

Grammar of a formatted conversation::

    conversation := turn*
    turn         := "<|im_start|>" role "\n" text "<|im_end|>" "\n"

Roles and texts must not contain a control string as it stands, of this or any
other common template. A control string is a first character and a rest; with
``k`` backslashes between them it is escaped ``k`` times. Escaping adds one
backslash to every such string, unescaping takes one from those that have any,
so any text comes back exactly. A line break in a role is written ``<|n|>``.

A conversation is first rendered as it is. The result is parsed by the grammar;
where the turns read back differ from the source, or a control string is left
inside a turn, it is rendered again with the conflicting content escaped. The
second rendering is parsed too, and a difference that remains is an error.

Defined results: a null role or text is the empty one; null turns come first,
equal turns in order of role and text; rows of a null conversation id are one
conversation; repeated rows are repeated turns; a conversation's rows are one
value, so it must fit into memory, as its digest demands; an empty table gives
an empty result. Only the four named columns are read, so others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Control strings of common templates, first character and rest.
CONTROL = [
    ("<", "|im_start|>"),
    ("<", "|im_end|>"),
    ("<", "|im_sep|>"),
    ("<", "|n|>"),
    ("<", "|system|>"),
    ("<", "|user|>"),
    ("<", "|assistant|>"),
    ("<", "|end|>"),
    ("<", "|eot_id|>"),
    ("<", "|start_header_id|>"),
    ("<", "|end_header_id|>"),
    ("<", "|begin_of_text|>"),
    ("<", "|end_of_text|>"),
    ("<", "|startoftext|>"),
    ("<", "|endoftext|>"),
    ("<", "start_of_turn>"),
    ("<", "end_of_turn>"),
    ("<", "s>"),
    ("<", "/s>"),
    ("<", "<SYS>>"),
    ("<", "</SYS>>"),
    ("[", "INST]"),
    ("[", "/INST]"),
]

START, STOP = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def _pattern(backslashes: str) -> str:
    """Java pattern of the control strings with such a run of backslashes."""
    quoted = lambda s: "".join("\\" + c if c in "|[]<>/" else c for c in s)
    by_first: dict[str, list[str]] = {}
    for first, rest in CONTROL:
        by_first.setdefault(first, []).append(quoted(rest))
    # the rest is looked at, not taken: it may begin with a first character
    return "|".join(f"(?<={quoted(a)}){backslashes}(?=\\\\*(?:{'|'.join(rests)}))" for a, rests in by_first.items())


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


_GAP = _literal(_pattern(""))  # where a backslash goes in
_ONE = _literal(_pattern(r"\\"))  # a backslash that goes out
_BARE = _literal("|".join("".join("\\" + c if c in "|[]<>/" else c for c in a + b) for a, b in CONTROL))


def _escaped(text: str) -> str:
    return rf"regexp_replace({text}, {_GAP}, '\\\\')"


def _unescaped(text: str) -> str:
    return f"regexp_replace({text}, {_ONE}, '')"


# A line break ends the role, so inside a role it is written as a control
# string, of which no other is left unescaped.
def _escaped_role(role: str) -> str:
    return rf"replace({_escaped(role)}, '\n', '<|n|>')"


def _unescaped_role(role: str) -> str:
    return _unescaped(rf"replace({role}, '<|n|>', '\n')")


def _rendered(turns: str, role: str, text: str) -> str:
    return rf"array_join(transform({turns}, t -> concat('{START}', {role}, '\n', {text}, '<|im_end|>\n')), '')"


def _parsed(formatted: str) -> str:
    """Turns of a formatted string: pieces between start marks, each up to the
    stop mark that ends it; the role is all before the first line break."""
    piece = (
        r"named_struct('role', substring_index(p, '\n', 1), 'text', "
        rf"substring(p, locate('\n', p) + 1, greatest(length(p) - locate('\n', p) - {len(STOP)}, 0)))"
    )
    raw = rf"transform(slice(split({formatted}, '<\\|im_start\\|>'), 2, size(split({formatted}, '<\\|im_start\\|>'))), p -> {piece})"
    return rf"transform({raw}, t -> named_struct('role', {_unescaped_role('t.role')}, 'text', {_unescaped('t.text')}))"


def conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its id and its turns in order."""
    ordered = F.sort_array(
        F.collect_list(
            F.struct(
                F.col(turn).alias("turn"),
                F.coalesce(F.col(role), F.lit("")).alias("role"),
                F.coalesce(F.col(text), F.lit("")).alias("text"),
            )
        )
    )
    return rows.groupBy(F.col(conv).alias("conv_id")).agg(ordered.alias("_rows")).select(
        "conv_id", F.expr("transform(_rows, t -> named_struct('role', t.role, 'text', t.text))").alias("turns")
    )


def formatted(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``formatted`` and ``parsed``: the turns read back from it."""
    whole = conversations(rows, conv, turn, role, text)
    plain = whole.withColumn("_plain", F.expr(_rendered("turns", "t.role", "t.text"))).withColumn("_read", F.expr(_parsed("_plain")))
    # a role may hold a backslash that unescaping would change: compared as well
    clear = F.expr(f"_read = turns and not exists(turns, t -> t.role rlike {_BARE} or t.text rlike {_BARE})")
    second = F.expr(_rendered("turns", _escaped_role("t.role"), _escaped("t.text")))
    chosen = plain.withColumn("formatted", F.when(clear, F.col("_plain")).otherwise(second))
    read = chosen.withColumn("parsed", F.expr(_parsed("formatted")))
    same = F.when(F.col("parsed") == F.col("turns"), F.col("parsed")).otherwise(
        F.raise_error(F.lit("a conversation does not survive its round trip"))
    )
    return read.select("conv_id", "formatted", same.alias("parsed"))


def digests(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Counts and digests of every conversation, read back from its format."""
    loss = f"array_join(transform(filter(parsed, t -> t.role = '{LOSS_ROLE}'), t -> t.text), '')"
    return (
        formatted(rows, conv, turn, role, text)
        .withColumn("_loss", F.expr(loss))
        .selectExpr(
            "conv_id",
            "cast(size(parsed) as bigint) as n_turns",
            r"sha2(array_join(transform(parsed, t -> concat(t.role, '\n', t.text, '\n')), ''), 256) as turns_sha256",
            "cast(length(_loss) as bigint) as loss_chars",
            "sha2(_loss, 256) as loss_sha256",
            "cast(length(formatted) as bigint) as formatted_chars",
        )
    )
