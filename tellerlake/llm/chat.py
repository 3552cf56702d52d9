"""Chat formatting: schema fingerprints choose declarative mappings to canonical turns.

A layout is known by the nested paths of its fields. The fingerprint of a row
is the set of those known paths that it has, a bit for each; it selects the most
specific layout (that of the most paths, then the first listed) whose paths it
contains, and the layout's mapping says where the turns are. Other known paths
play no part, but a ``system`` text beside another layout stays as its first turn. Canonical turns are (role, text) in order. The
template writes a turn as ``<s>role``, a line break, the text and ``</s>``, and
escapes what could be read as its own marks, so that every output can be read
back exactly. DataFrame functions only.

Turns of one conversation are formatted row by row, joined in blocks of
BLOCK_TURNS turns and the blocks joined: a long conversation is not gathered
turn by turn into one task, though its one output string is one value.

Defined results: null texts and roles are empty; turns follow their number,
those that tie (or have none, first) their role and then their text; repeated
rows are repeated turns; a null conversation id is one conversation; a list
has the paths that any of its elements has; unknown layouts give null turns; an empty table gives an empty result; columns outside
the known paths play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

TURNS = "array<struct<role:string,text:string>>"
BLOCK_TURNS = 256
OPEN, CLOSE = "<s>", "</s>"
#: Character to its escape. After the backslash no escape contains another's first character.
ESCAPES = {"\\": "\\0", "[": "\\1", "<": "\\2", "\n": "\\3"}
ASSISTANT = "assistant"

#: Each layout: its paths, and its turns as (role or path of it, paths of the text) or a list of turns.
LAYOUTS = {
    "rows": {"paths": ("turn", "role", "text"), "order": "turn", "each": ("role", "text")},
    "completion": {"paths": ("prompt", "completion"), "turns": (("user", ("prompt",)), ("assistant", ("completion",)))},
    "response": {"paths": ("prompt", "response"), "turns": (("user", ("prompt",)), ("assistant", ("response",)))},
    "system_response": {
        "paths": ("system", "prompt", "response"),
        "turns": (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
    },
    "instruction": {"paths": ("instruction", "output"), "turns": (("user", ("instruction",)), ("assistant", ("output",)))},
    "instruction_input": {
        "paths": ("instruction", "input", "output"),
        "turns": (("user", ("instruction", "input")), ("assistant", ("output",))),
    },
    "messages": {"paths": ("messages[].role", "messages[].content"), "list": ("messages", "role", "content")},
    "shared": {"paths": ("conversations[].from", "conversations[].value"), "list": ("conversations", "from", "value")},
}
#: Other names of the canonical roles, in layouts whose turns are lists; rows keep their role.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
KNOWN = sorted({p for layout in LAYOUTS.values() for p in layout["paths"]})
#: Layouts from the most specific on; the sort keeps the order of those with equally many paths.
SPECIFIC = sorted(LAYOUTS, key=lambda name: -len(LAYOUTS[name]["paths"]))
SYSTEM = "system"


def fingerprint(paths) -> int:
    """The known ones among nested field paths, as bits."""
    return sum(1 << k for k, p in enumerate(KNOWN) if p in set(paths))


FINGERPRINTS = {name: fingerprint(LAYOUTS[name]["paths"]) for name in SPECIFIC}


def paths_of(schema: StructType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema; ``[]`` stands for the elements of an array."""
    found = []
    for field in schema.fields:
        path, kind = prefix + field.name, field.dataType
        while isinstance(kind, ArrayType):
            path, kind = path + "[]", kind.elementType
        found += paths_of(kind, path + ".") if isinstance(kind, StructType) else [path]
    return found


def layout_of(schema: StructType) -> str | None:
    own = fingerprint(paths_of(schema))
    return next((name for name, bits in FINGERPRINTS.items() if own & bits == bits), None)


def _string(value: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(value, "$." + path, "string"), F.lit(""))


def _role(role: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(names[role], role, F.lit(""))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"))


def _mapped(value: Column, layout: dict) -> Column:
    if "list" in layout:
        path, role, text = layout["list"]
        listed = F.try_variant_get(value, "$." + path, "array<variant>")
        turns = F.transform(listed, lambda t: _turn(_role(_string(t, role)), _string(t, text)))
    else:
        each = []
        for role, paths in layout["turns"]:
            parts = F.filter(F.array(*[_string(value, p) for p in paths]), lambda p: p != "")
            each.append(_turn(F.lit(role), F.array_join(parts, "\n\n")))
        turns = F.array(*each)
    if SYSTEM in layout["paths"]:
        return turns
    # A list may hold the same system turn itself.
    said = F.array(_turn(F.lit(SYSTEM), _string(value, SYSTEM)))
    return F.concat(F.filter(said, lambda t: (t["text"] != "") & ~F.exists(turns, lambda o: o == t)), turns)


def json_turns(rows: DataFrame, column: str, out: str = "turns") -> DataFrame:
    """``rows`` with ``layout`` and the canonical turns of a JSON column whose rows may differ in layout."""
    parsed = rows.withColumn("__value", F.try_parse_json(F.col(f"`{column}`")))
    value = F.col("__value")

    def has(path: str) -> Column:
        start, _, rest = path.partition("[].")
        if not rest:
            return F.try_variant_get(value, "$." + path, "variant").isNotNull()
        listed = F.try_variant_get(value, "$." + start, "array<variant>")
        return F.exists(listed, lambda t: F.try_variant_get(t, "$." + rest, "variant").isNotNull())

    bits = [F.when(has(p), F.lit(1 << k)).otherwise(F.lit(0)) for k, p in enumerate(KNOWN)]
    parsed = parsed.withColumn("__print", reduce(Column.__add__, bits))
    layouts = {name: own for name, own in FINGERPRINTS.items() if "each" not in LAYOUTS[name]}
    names = [F.when(F.col("__print").bitwiseAND(own) == own, F.lit(name)) for name, own in layouts.items()]
    parsed = parsed.withColumn("layout", F.coalesce(*names))
    cases = [F.when(F.col("layout") == name, _mapped(value, LAYOUTS[name])) for name in layouts]
    return parsed.withColumn(out, F.coalesce(*cases).cast(TURNS)).drop("__value", "__print")


def escaped(text: Column) -> Column:
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), ESCAPES.items(), text)


def unescaped(text: Column) -> Column:
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[1]), F.lit(pair[0])), reversed(ESCAPES.items()), text)


def written(role: Column, text: Column) -> Column:
    """One turn in the template; only roles escape line breaks, the first one ends the role."""
    body = reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), list(ESCAPES.items())[:3], text)
    return F.concat(F.lit(OPEN), escaped(role), F.lit("\n"), body, F.lit(CLOSE))


def format_turns(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: written(t["role"], t["text"])), "")


def format_rows(rows: DataFrame, id: str = "conv_id") -> DataFrame:
    """(``id``, formatted) of a table whose layout is a row for each turn."""
    layout = LAYOUTS.get(layout_of(rows.schema), {})
    if "each" not in layout:
        raise ValueError(f"no layout of a row a turn has the paths {paths_of(rows.schema)}")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in layout["each"])
    number = F.col(layout["order"]).cast("long")
    key = F.col(f"`{id}`").alias(id)
    first = F.lit(-(2**63))
    turn = F.struct(
        F.coalesce(number, first).alias("number"),
        role.alias("role"),
        text.alias("text"),
        written(role, text).alias("out"),
    )
    blocks = rows.select(key, F.floor(number / BLOCK_TURNS).alias("block"), turn.alias("turn")).groupBy(id, "block")
    joined = blocks.agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    part = F.struct(F.coalesce("block", first).alias("block"), F.array_join("turns.out", "").alias("out"))
    parts = F.sort_array(F.collect_list(part))
    return joined.groupBy(id).agg(F.array_join(parts["out"], "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """The canonical turns of a formatted conversation."""
    pieces = F.filter(F.split(formatted, CLOSE), lambda p: p != "")

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        text = F.substring(piece, F.length(role) + 2, F.length(piece))
        name = F.substring(role, F.lit(len(OPEN) + 1), F.length(role))
        return F.struct(unescaped(name).alias("role"), unescaped(text).alias("text"))

    return F.transform(pieces, turn)


def loss_texts(turns: Column) -> Column:
    """The texts under the loss mask: those of the assistant's turns."""
    return F.transform(F.filter(turns, lambda t: t["role"] == ASSISTANT), lambda t: t["text"])
