"""Chat formatting of records in different layouts, chosen by schema fingerprint.

The fingerprint of a record is a hash of the nested field paths it has, out of the paths
that any known layout uses; other fields do not count. It selects a declared layout, which
says where the turns are. Turns of one conversation are then joined in order by a template
that marks each turn; a loss mask gives the places of the assistant's texts.

The template of a turn is ``<turn>role``, a line feed, the text, ``</turn>`` and a line
feed. Inside roles and texts a backslash becomes ``\\b`` and the ``<`` of a mark becomes
``\\l``, so a mark never occurs in them and both can be restored.

Only DataFrame functions are used. Rows meet by conversation, in one shuffle; the places
are running sums in it.

Cases: a null role or text is an empty one; turns with equal numbers are ordered by role
and text, repeated rows stay as turns of their own; rows with a null conversation id are
one conversation; a record of no known layout, or with an empty list, has no turns (see
``unmapped``); fields beside those of a layout do not matter, also when they are named
like the results; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are.

    Either ``items``: the path of a list whose entries have a ``role`` and a ``text``
    field; or ``turns``: a role for each turn and the paths of its text, joined by blank
    lines where they are not empty. ``role`` may also be the path of a single turn's role.
    """

    name: str
    items: str = ""
    role: str = ""
    text: str = ""
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def paths(self) -> list[str]:
        if self.items:
            return sorted(f"{self.items}[].{p}" for p in (self.role, self.text))
        return sorted({*filter(None, [self.role, self.text]), *chain(*(t for _, t in self.turns))})


def _pairs(name: str, question: tuple[str, ...], answer: str) -> tuple[Layout, Layout]:
    turns = (("user", question), ("assistant", (answer,)))
    return (
        Layout(name, turns=turns),
        Layout(f"{name} with system", turns=(("system", ("system",)), *turns)),
    )


#: The layouts that are known. A layout is added by declaring it here or by the caller.
LAYOUTS = (
    Layout("rows by turn", role="role", text="text"),
    Layout("messages", items="messages", role="role", text="content"),
    Layout(
        "conversations", items="conversations", role="from", text="value",
        roles={"human": "user", "gpt": "assistant", "bot": "assistant"},
    ),
    *_pairs("prompt and response", ("prompt",), "response"),
    *_pairs("prompt and completion", ("prompt",), "completion"),
    *_pairs("question and answer", ("question",), "answer"),
    *_pairs("instruction", ("instruction",), "output"),
    *_pairs("instruction with input", ("instruction", "input"), "output"),
)

_TURNS = "array<struct<role string, text string>>"


def _known(layouts: tuple[Layout, ...]) -> list[str]:
    return sorted({p for layout in layouts for p in layout.paths})


def _fingerprint(has: dict[str, Column]) -> Column:
    return F.xxhash64(F.concat_ws(",", *(F.when(has[p], F.lit(p)) for p in sorted(has))))


def _of(layout: Layout) -> Column:
    return F.xxhash64(F.lit(",".join(layout.paths)))


def _renamed(role: Column, roles: dict[str, str]) -> Column:
    for old, new in roles.items():
        role = F.when(role == old, new).otherwise(role)
    return role


def _turns(layout: Layout, value: dict[str, Column]) -> Column:
    """The turns of a record of this layout. ``value``: columns by top-level path."""
    if layout.items:
        return F.transform(
            value[layout.items],
            lambda item: F.struct(
                _renamed(item[layout.role].cast("string"), layout.roles).alias("role"),
                item[layout.text].cast("string").alias("text"),
            ),
        )
    if layout.role:
        one = F.struct(
            _renamed(value[layout.role].cast("string"), layout.roles).alias("role"),
            value[layout.text].cast("string").alias("text"),
        )
        return F.array(one)
    return F.array(
        *(
            F.struct(
                F.lit(role).alias("role"),
                F.concat_ws(
                    "\n\n",
                    *(
                        F.when(value[p].cast("string") != "", value[p].cast("string"))
                        for p in paths
                    ),
                ).alias("text"),
            )
            for role, paths in layout.turns
        )
    )


def _canonical(
    df: DataFrame,
    has: dict[str, Column],
    value: dict[str, Column],
    conv_id: Column,
    turn: Column,
    layouts: tuple[Layout, ...],
) -> DataFrame:
    chosen = turns = None
    for layout in layouts:
        if all(p.split("[")[0] in value for p in layout.paths):
            hit = F.col("_print") == _of(layout)
            made = _turns(layout, value).cast(_TURNS)
            chosen = F.when(hit, layout.name) if chosen is None else chosen.when(hit, layout.name)
            turns = F.when(hit, made) if turns is None else turns.when(hit, made)
    if chosen is None:
        chosen, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    rows = df.withColumn("_print", _fingerprint(has)).select(
        conv_id.cast("long").alias("conv_id"), turn.cast("long").alias("turn"),
        chosen.alias("layout"), F.posexplode_outer(turns).alias("place", "one"),
    )
    return rows.select("conv_id", "turn", "place", "layout", "one.role", "one.text")


def from_columns(
    df: DataFrame,
    id_col: str = "conv_id",
    turn_col: str | None = None,
    layouts: tuple[Layout, ...] = LAYOUTS,
) -> DataFrame:
    """Canonical turns of records whose fields are columns.

    Result: conv_id, turn (of ``turn_col``, else 0), place in the record, layout, role,
    text. The paths of the schema make the fingerprint, the same for all rows.
    """
    fields = {f.name: f.dataType for f in df.schema}
    has, value = {}, {}
    for path in _known(layouts):
        top, _, inner = path.partition("[].")
        kind = fields.get(top)
        found = kind is not None and top != turn_col and top != id_col
        if found and inner:
            found = (
                isinstance(kind, T.ArrayType)
                and isinstance(kind.elementType, T.StructType)
                and inner in kind.elementType.names
            )
        has[path] = F.lit(found)
        if found:
            value[top] = F.col(f"`{top}`")
    turn = F.col(f"`{turn_col}`") if turn_col else F.lit(0)
    return _canonical(df, has, value, F.col(f"`{id_col}`"), turn, layouts)


def from_json(
    df: DataFrame,
    json_col: str = "record",
    id_col: str = "conv_id",
    layouts: tuple[Layout, ...] = LAYOUTS,
) -> DataFrame:
    """Canonical turns of records that are JSON objects, each in a layout of its own.

    The entries of a list are taken to have the fields of its first entry.
    """
    known = _known(layouts)
    lists = sorted({layout.items for layout in layouts if layout.items})
    schema = T.StructType()
    for layout in layouts:
        if layout.items:
            entry = T.StructType([T.StructField(n, T.StringType()) for n in (layout.role, layout.text)])
            if layout.items not in schema.names:
                schema.add(layout.items, T.ArrayType(entry))
            else:
                own = schema[layout.items].dataType.elementType
                for f in entry:
                    if f.name not in own.names:
                        own.add(f)
    for path in known:
        if "[]" not in path and path not in schema.names:
            schema.add(path, T.StringType())
    json = F.col(f"`{json_col}`")
    keys = {"": F.json_object_keys(json)}
    for name in lists:
        keys[name] = F.json_object_keys(F.get_json_object(json, f"$.{name}[0]"))
    has = {}
    for path in known:
        top, _, inner = path.partition("[].")
        has[path] = F.coalesce(
            F.array_contains(keys[top if inner else ""], inner or top), F.lit(False)
        )
    read = df.withColumn("_value", F.from_json(json, schema))
    value = {f.name: F.col(f"_value.`{f.name}`") for f in schema}
    return _canonical(read, has, value, F.col(f"`{id_col}`"), F.lit(0), layouts)


def unmapped(turns: DataFrame) -> DataFrame:
    """(conv_id, turn) of the records that no layout fits."""
    return turns.where("layout is null").select("conv_id", "turn")


_MARKS = "<(/?turn)"


def _escaped(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\b"))
    return F.regexp_replace(text, _MARKS, r"\\l$1")


def _restored(text: Column) -> Column:
    text = F.replace(text, F.lit("\\l"), F.lit("<"))
    text = F.replace(text, F.lit("\\n"), F.lit("\n"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def format_turns(turns: DataFrame, learned: str = "assistant") -> DataFrame:
    """(conv_id, formatted, mask) of every conversation.

    ``mask`` has an entry for each turn: the place where it starts in ``formatted`` and
    the range whose loss counts, empty for turns of other roles than ``learned``. Places
    count code points from 0; ends are exclusive.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = [F.col("turn"), F.col("place"), role, text]
    head = F.concat(
        F.lit("<turn>"), F.replace(_escaped(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n")
    )
    rows = (
        turns.where("layout is not null and place is not null")
        .withColumn("head", head)
        .withColumn("body", _escaped(F.col("text")))
        .withColumn("piece", F.concat("head", "body", F.lit("</turn>\n")))
    )
    running = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.length("piece")).over(running) - F.length("piece")
    loss = F.col("turn_start") + F.length("head")
    end = loss + F.when(role == learned, F.length("body")).otherwise(0)
    grouped = (
        rows.withColumn("turn_start", start.cast("long"))
        .withColumn("nth", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
        .groupBy("conv_id")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "nth", "turn_start", loss.alias("loss_start"), end.alias("loss_end"), "piece"
                    )
                )
            ).alias("all")
        )
    )
    return grouped.select(
        "conv_id",
        F.array_join("all.piece", "").alias("formatted"),
        F.transform(
            "all",
            lambda t: F.struct(t["turn_start"], t["loss_start"], t["loss_end"]),
        ).alias("mask"),
    )


def _pieces(formatted: str) -> Column:
    parts = F.split(F.col(formatted), "</turn>\n", -1)
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def read_turns(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns``: the roles and texts read back from the string."""
    return formatted.withColumn(
        "turns",
        F.transform(
            _pieces("formatted"),
            lambda p: F.struct(
                _restored(F.substr(F.substring_index(p, "\n", 1), F.lit(7))).alias("role"),
                _text(F.substr(p, F.instr(p, "\n") + 1)).alias("text"),
            ),
        ),
    )


def _text(text: Column) -> Column:
    text = F.replace(text, F.lit("\\l"), F.lit("<"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def learned_text(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``learned``: all text under the mask, restored."""
    return formatted.withColumn(
        "learned",
        F.array_join(
            F.zip_with(
                _pieces("formatted"),
                "mask",
                lambda p, m: _text(
                    F.substr(
                        p,
                        (m["loss_start"] - m["turn_start"] + 1).cast("int"),
                        (m["loss_end"] - m["loss_start"]).cast("int"),
                    )
                ),
            ),
            "",
        ),
    )
