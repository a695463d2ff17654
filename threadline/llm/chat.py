"""Chat formatting: schema fingerprints pick declarative mappings to canonical turns.

A record is a JSON object in any of several layouts (prompt and completion,
instruction with history, message lists ...).  Its nested field paths, sorted and
hashed, are its fingerprint; each ``Layout`` states which paths it has and how they
become turns, and registers the fingerprints of all its forms.  Records of unknown
fingerprints are handed back by ``canonical`` with their paths, never guessed at.

Turns are written with marks of a template into parts of bounded length, each with
the spans of its loss mask (the assistant's texts, in code points).  Control strings
inside texts and roles get one more backslash after their first character, which
reading takes away again, so that every text survives.

Defined results: a null text or role is empty; rows of one conversation are ordered
by turn (null first), then role and text; repeated rows are turns of their own; a
null conversation id is one conversation; a record that is null, no JSON object or of
an unknown fingerprint has no layout and no turns; an empty table gives no rows; extra
columns are ignored.  A conversation of any length is handled in records and parts of
bounded size.  Only the digests of a conversation, which are sequential by definition,
are taken by one task, which keeps a running hash and one part at a time.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import batch_rows, stored

TURNS = "array<struct<role string, text string>>"
#: Fields that carry no turns; a fingerprint leaves them out.
IGNORED = ("id", "meta", "source")


# ---- layouts -----------------------------------------------------------------


@dataclass(frozen=True)
class One:
    """One turn of a fixed role; ``text`` names a path, or several that are joined by an empty line."""

    role: str
    text: tuple[str, ...]
    optional: bool = False

    def forms(self):
        return [frozenset(self.text)] + ([frozenset()] if self.optional else [])

    def turns(self, record):
        if self.optional and self.text[0] not in record:
            return []
        return [(self.role, "\n\n".join(t for t in (plain(at(record, p)) for p in self.text) if t))]


@dataclass(frozen=True)
class Each:
    """A turn for each element of a list; ``roles`` renames roles, ``also`` names further paths of an element."""

    items: str
    role: str
    text: str
    roles: tuple[tuple[str, str], ...] = ()
    also: tuple[str, ...] = ()

    def forms(self):
        return [frozenset(f"{self.items}[].{p}" for p in (self.role, self.text, *self.also)), frozenset({f"{self.items}[]"})]

    def turns(self, record):
        names = dict(self.roles)
        found = [(plain(at(x, self.role)), plain(at(x, self.text))) for x in at(record, self.items) or []]
        return [(names.get(role, role), text) for role, text in found]


@dataclass(frozen=True)
class Pairs:
    """A list of pairs: what the user said and what was answered."""

    items: str

    def forms(self):
        return [frozenset({f"{self.items}[][]"}), frozenset({f"{self.items}[]"}), frozenset()]

    def turns(self, record):
        return [(role, plain(x)) for pair in at(record, self.items) or [] for role, x in zip(("user", "assistant"), pair, strict=True)]


@dataclass(frozen=True)
class Layout:
    name: str
    steps: tuple

    def fingerprints(self) -> set[str]:
        return {fingerprint(frozenset().union(*forms)) for forms in product(*(s.forms() for s in self.steps))}


LAYOUTS = (
    Layout("turn", (Each("turns", "role", "text"),)),
    Layout("messages", (Each("messages", "role", "content"),)),
    Layout("authored", (Each("messages", "author.role", "content.parts[]"),)),
    Layout("typed", (Each("messages", "role", "content[].text", also=("content[].type",)),)),
    Layout("exchange", (One("system", ("system",), True), Each("conversations", "from", "value", (("human", "user"), ("gpt", "assistant"))))),
    Layout("pair", (One("user", ("prompt",)), One("assistant", ("completion",)))),
    Layout("question", (One("system", ("system_prompt",), True), One("user", ("question",)), One("assistant", ("response",)))),
    Layout("instruction", (One("system", ("system",), True), Pairs("history"), One("user", ("instruction",)), One("assistant", ("output",)))),
    Layout("instruction with input", (One("system", ("system",), True), Pairs("history"), One("user", ("instruction", "input")), One("assistant", ("output",)))),
)


def plain(x) -> str:
    """A text; the parts of a list are joined."""
    if isinstance(x, list):
        return "".join(map(plain, x))
    return "" if x is None else x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)


def at(record, path: str):
    """The value at a path such as ``content.parts[]``; lists on the way give lists."""
    for name in path.split("."):
        name = name.removesuffix("[]")
        if isinstance(record, list):
            record = [x.get(name) if isinstance(x, dict) else None for x in record]
        else:
            record = record.get(name) if isinstance(record, dict) else None
    return record


def paths(x, prefix: str = "") -> set[str]:
    """The nested field paths of a JSON value; ``[]`` marks the elements of a list."""
    if isinstance(x, dict):
        return set().union(*(paths(v, f"{prefix}.{k}" if prefix else k) for k, v in x.items())) if x else {prefix + "{}"}
    if isinstance(x, list):
        return set().union(*(paths(v, prefix + "[]") for v in x)) if x else {prefix + "[]"}
    return {prefix}


def fingerprint(found) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


def registered(layouts=LAYOUTS) -> dict[str, Layout]:
    """Layouts by fingerprint; two layouts with the same paths can't be told apart and are refused."""
    by: dict[str, Layout] = {}
    for layout in layouts:
        for print_ in layout.fingerprints():
            other = by.setdefault(print_, layout)
            if other is not layout and not all(isinstance(s, Each) for s in (*other.steps, *layout.steps)):
                raise ValueError(f"{layout.name} and {other.name} have the same paths")
    return by


def converted(text: str | None, by: dict[str, Layout], ignored=IGNORED):
    """Fingerprint, layout name, turns and paths of one record."""
    try:
        record = json.loads(text, strict=False) if text is not None else None
    except ValueError:
        record = None
    if not isinstance(record, dict):
        return None, None, [], []
    record = {k: v for k, v in record.items() if k not in ignored}
    found = paths(record)
    print_ = fingerprint(found)
    layout = by.get(print_)
    if layout is not None:
        try:
            return print_, layout.name, [t for s in layout.steps for t in s.turns(record)], []
        except ValueError:  # a pair that is none
            pass
    return print_, None, [], sorted(found)


def canonical(records: DataFrame, layouts=LAYOUTS, ignored=IGNORED, id_col: str = "conv_id", part: str = "part", column: str = "record") -> DataFrame:
    """id, part, fingerprint, layout (null if unknown), turns, unknown (the paths of an unknown record) of every record."""
    by = registered(layouts)

    def convert(frames):
        import pandas as pd

        for f in frames:
            rows = [converted(t, by, ignored) for t in f["record"]]
            turns = [[{"role": r, "text": t} for r, t in x[2]] for x in rows]
            yield pd.DataFrame({"id": f["id"], "part": f["part"], "fingerprint": [x[0] for x in rows], "layout": [x[1] for x in rows], "turns": turns, "unknown": [x[3] for x in rows]})

    kind = dict(records.dtypes)[id_col]
    rows = records.select(F.col(id_col).cast("string").alias("id"), F.col(part).cast("long").alias("part"), F.col(column).alias("record"))
    done = rows.mapInPandas(convert, f"id string, part long, fingerprint string, layout string, turns {TURNS}, unknown array<string>")
    return done.withColumn("id", F.col("id").cast(kind))


def turns(found: DataFrame) -> DataFrame:
    """id, seq (order within the conversation), role, text of canonical records."""
    return found.select("id", "part", F.posexplode("turns").alias("pos", "t")).select("id", (F.shiftleft("part", 32) + F.col("pos")).alias("seq"), "t.role", "t.text")


# ---- template ----------------------------------------------------------------

#: What a control string has after its first character, ``<`` or ``[``.
RESTS = r"/?s>|/?INST\]|</?SYS>>|ROLE:|:ROLE\]|/ROLE\]"
ESCAPE = rf"([<\[])(\\*)({RESTS})"
#: Marks before and after the text of a turn; other roles are written out.
MARKS = {"user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n\n")}
OTHER = ("[ROLE:", "[:ROLE] ", " [/ROLE]")
_READ = re.compile(r"<s>\[INST\] (?P<user>.*?) \[/INST\]| (?P<assistant>.*?) </s>|<<SYS>>\n(?P<system>.*?)\n<</SYS>>\n\n|\[ROLE:(?P<role>.*?)\[:ROLE\] (?P<other>.*?) \[/ROLE\]", re.S)
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({RESTS})")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def parsed(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted part."""
    out, i = [], 0
    while i < len(text):
        m = _READ.match(text, i)
        if m is None:
            raise ValueError(f"no turn at {i}")
        role = m.lastgroup
        out.append((unescaped(m["role"]) if role == "other" else role, unescaped(m[role])))
        i = m.end()
    return out


def formatted(found: DataFrame, part_chars: int = 1 << 18) -> DataFrame:
    """id, part, text, loss (spans of the loss mask) of turns (id, seq, role, text).

    A part holds whole turns, the first of which starts within ``part_chars`` of the part before.
    """
    role = F.col("role")
    opens = F.concat(F.lit(OTHER[0]), escaped(role), F.lit(OTHER[1]))
    closes = F.lit(OTHER[2])
    for name, (a, b) in MARKS.items():
        opens, closes = F.when(role == name, a).otherwise(opens), F.when(role == name, b).otherwise(closes)
    marked = found.select("id", "seq", (role == "assistant").alias("loss"), opens.alias("o"), escaped(F.col("text")).alias("e"), closes.alias("c"))
    sized = marked.select("id", "seq", "loss", F.concat("o", "e", "c").alias("piece"), F.length("o").alias("open"), F.length("e").alias("n"))
    before = F.sum(F.length("piece")).over(Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    placed = sized.withColumn("before", F.coalesce(before, F.lit(0))).withColumn("part", F.floor(F.col("before") / part_chars))
    row = F.struct("seq", "before", "piece", "loss", "open", "n")
    parts = placed.groupBy("id", "part").agg(F.sort_array(F.collect_list(row)).alias("r"), F.min("before").alias("base"))
    spans = F.transform(F.filter("r", lambda x: x["loss"]), lambda x: F.struct((x["before"] - F.col("base") + x["open"]).alias("start"), (x["before"] - F.col("base") + x["open"] + x["n"]).alias("end")))
    return parts.select("id", "part", F.array_join(F.col("r.piece"), "").alias("text"), spans.alias("loss"))


def read(parts: DataFrame) -> DataFrame:
    """id, part, pos, role, text of the turns of formatted parts."""

    def each(frames):
        import pandas as pd

        for f in frames:
            rows = [(i, p, [{"role": r, "text": t} for r, t in parsed(text)]) for i, p, text in zip(f["id"], f["part"], f["text"], strict=True)]
            yield pd.DataFrame(rows, columns=["id", "part", "turns"])

    kind = dict(parts.dtypes)["id"]
    done = parts.select(F.col("id").cast("string").alias("id"), "part", "text").mapInPandas(each, f"id string, part long, turns {TURNS}")
    return done.select(F.col("id").cast(kind).alias("id"), "part", F.posexplode("turns").alias("pos", "t")).select("id", "part", "pos", "t.role", "t.text")


def digests(parts: DataFrame) -> DataFrame:
    """n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars per id, all from the formatted parts and their masks."""

    class Running:
        def __init__(self, name):
            self.name, self.n, self.loss_n, self.chars = name, 0, 0, 0
            self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

        def take(self, text, spans):
            for role, said in parsed(text):
                self.n += 1
                self.turns.update(f"{role}\n{said}\n".encode())
            for s in spans:
                said = unescaped(text[s["start"] : s["end"]])
                self.loss_n += len(said)
                self.loss.update(said.encode())
            self.chars += len(text)

        def row(self):
            return (self.name, self.n, self.turns.hexdigest(), self.loss_n, self.loss.hexdigest(), self.chars)

    def run(frames):
        import pandas as pd

        columns = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now = None
        for f in frames:
            out = []
            for name, text, spans in zip(f["id"], f["text"], f["loss"], strict=True):
                if now is None or now.name != name:
                    out += [now.row()] if now else []
                    now = Running(name)
                now.take(text, spans)
            yield pd.DataFrame(out, columns=columns)
        if now:
            yield pd.DataFrame([now.row()], columns=columns)

    kind = dict(parts.dtypes)["id"]
    rows = parts.select(F.col("id").cast("string").alias("id"), "part", "text", "loss").repartition("id").sortWithinPartitions("id", "part")
    done = rows.mapInPandas(run, "id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return done.withColumn("id", F.col("id").cast(kind))


def round_trip(records: DataFrame) -> DataFrame:
    """Records to turns to written parts, and the digests read back from these."""
    spark = records.sparkSession
    with batch_rows(spark, 256):
        parts = stored(formatted(turns(canonical(records))), "chat")
        return stored(digests(parts), "chat-digests")


# ---- a table of turns in mixed layouts -----------------------------------------


def records_of(table: DataFrame, most_turns: int = 64) -> DataFrame:
    """conv_id, part, record of a table of turns (conv_id, turn, role, text), in mixed layouts.

    Each run of ``most_turns`` turns becomes one JSON record, in the layouts that can hold it;
    one of those is picked by a hash of the conversation.
    """
    rows = table.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("pos", F.row_number().over(order) - 1).withColumn("part", F.floor(F.col("pos") / most_turns))
    r = F.col("r")
    runs = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("r"))
    known = F.array_join(F.transform(r["role"], lambda x: F.when(x.isin("system", "user", "assistant"), F.substring(x, 1, 1)).otherwise("?")), "")
    head = F.when(r[0]["role"] == "system", 1).otherwise(0)
    last = F.size("r") - 1
    # a null field is left out of the JSON
    system = F.when(r[0]["role"] == "system", r[0]["text"])

    def texts(i):
        return F.try_element_at(r, (i + 1).cast("int"))["text"]

    history = F.transform(F.when(last - head > 1, F.sequence(head, last - 3, F.lit(2))), lambda i: F.array(texts(i), texts(i + 1)))
    pick = F.pmod(F.xxhash64("conv_id"), F.lit(6))
    pairs, single = known.rlike("^s?(ua)+$"), known.rlike("^s?ua$")

    def listed(f):
        return F.transform(r, f)

    record = (
        F.when((pick == 0) & pairs, F.to_json(F.struct(F.lit("instruction").alias("source"), system.alias("system"), history.alias("history"), texts(last - 1).alias("instruction"), texts(last).alias("output"))))
        .when((pick == 1) & single & (head == 0), F.to_json(F.struct(texts(head).alias("prompt"), texts(last).alias("completion"))))
        .when((pick == 2) & single, F.to_json(F.struct(system.alias("system_prompt"), texts(last - 1).alias("question"), texts(last).alias("response"))))
        .when((pick <= 2) & ~known.contains("?"), F.to_json(F.struct(listed(lambda x: F.struct(F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"]).alias("from"), x["text"].alias("value"))).alias("conversations"))))
        .when(pick == 3, F.to_json(F.struct(listed(lambda x: F.struct(F.struct(x["role"].alias("role")).alias("author"), F.struct(F.array(x["text"]).alias("parts")).alias("content"))).alias("messages"))))
        .when(pick == 4, F.to_json(F.struct(listed(lambda x: F.struct(x["role"].alias("role"), F.array(F.struct(F.lit("text").alias("type"), x["text"].alias("text"))).alias("content"))).alias("messages"))))
        .when(pick == 5, F.to_json(F.struct(listed(lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))))
        .otherwise(F.to_json(F.struct(listed(lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages"))))
    )
    return runs.select("conv_id", "part", record.alias("record"))
