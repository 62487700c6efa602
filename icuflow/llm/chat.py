"""Chat formatting: transcripts to canonical turns by a hidden Markov model.

A transcript is written in one style: one way of marking speakers (``User:``, ``### User:``,
``[user]`` ...) and one name for each role.  The style is a hidden variable of the whole
transcript: of the marker-like lines it explains the most, names that go together preferred;
a marker-like line of another style is text and keeps every character.

In the style, a transcript is read line by line.  A hidden state is a role with "begins a
turn" or "goes on"; a line shows a speaker marker (user-like, assistant-like,
system-like, a numbered speaker, or none) and its other features: blank, ends as
a question, long.  Viterbi finds the likeliest roles, so a marker that names
nobody gets its role from its neighbours.  The transcripts of a batch advance
together, one line at a time.  A turn is rendered as ``<|role|>``, its text and
``<|end|>``, on lines of their own.

A long conversation is rendered in parts of ``PART_TURNS`` turn numbers, a row
each, but its roles are those of one parse of the whole.  Each part gives the
score of the best path from every state before it to every state at its end; these
tables, chained in part order, tell the state before and at the end of each part.
Turns whose numbers lie ``PART_TURNS`` or more apart (only turns of different parts
can) are not neighbours: what was said before, or whether anything was, is unknown.

``transcripts_of`` writes turns so that they can be read back whole: a line of a text that looks
like a marker gets a backslash, which ``escaped`` reading takes away again, and a role other
than the three is written as a tag of its own name, which the turn keeps.  Plain reading
leaves backslashes alone.

Defined cases: an empty transcript has no turns; lines before the first marker
are a turn of the likeliest role; a null role or text in a table of turns is
unmarked or empty; turns with equal numbers follow by role and text; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote_plus

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
# Turns of one conversation are read and rendered in parts of so many turn numbers, so that none is unbounded.
PART_TURNS = 256
_NAMES = {"system": "system|context|instructions", "user": "user|human|question|q|customer|prompt|instruction",
          "assistant": "assistant|ai|bot|answer|a|response|model"}
_ANY = "|".join(_NAMES.values())
_ROLE_OF = {n: k for k, names in enumerate(_NAMES.values()) for n in names.split("|")}
# Ways of writing a marker, numbered speakers, and a tag with any other name.
_WRITTEN = [rf"({_ANY}): ?", rf"#{{2,3}} ({_ANY}):? ?", rf"<\|({_ANY})\|> ?", rf"\[({_ANY})\] ?", rf"\*\*({_ANY}):\*\* ?"]
_NUMBERED, _TAG = r"speaker \d+: ?", r"<\|([^|\n]*)\|> ?"
_SYNTAX = [re.compile(p, re.I) for p in _WRITTEN]
_SPEAKER, _TAGGED = re.compile(_NUMBERED, re.I), re.compile(_TAG)
# What an escaped line begins with, for Java and Python alike.
_ESCAPED = "(?i)\\n(?=\\\\|" + "|".join(p.replace("(", "(?:", 1) for p in [*_WRITTEN, _NUMBERED, _TAG]) + ")"
# Names that go together; of styles that explain as many lines these come first.
_PAIRS = {("user", "assistant"), ("human", "ai"), ("human", "assistant"), ("q", "a"), ("question", "answer"), ("prompt", "response"),
          ("instruction", "response"), ("customer", "bot"), ("user", "ai"), ("user", "bot"), ("user", "model")}
SPEAKER, NO_MARKER = 3, 4
# In escaped writing: a tag with a name of its own, a line that goes on for certain, and a role known for certain.
NAMED, CONTINUED, CERTAIN = 5, 6, 7
# P(marker | state): rows are the roles; a turn that begins shows a marker, one that goes on hardly ever does.
_BEGIN = np.array([[0.888, 0.02, 0.02, 0.002, 0.07], [0.005, 0.65, 0.015, 0.28, 0.05], [0.005, 0.015, 0.65, 0.28, 0.05]])
_GO_ON = np.array([0.0005, 0.0005, 0.0005, 0.0005, 0.998])
# A tag tells nothing of the three roles; what escaped writing makes certain leaves next to nothing to the rest.
_NEVER = 1e-12
_BEGIN = np.concatenate([_BEGIN, np.full((3, 1), 0.3), np.full((3, 1), _NEVER), np.where(np.eye(3) > 0, 1.0, _NEVER)], axis=1)
_GO_ON = np.concatenate([_GO_ON, [_NEVER, 1.0], np.full(3, _NEVER)])
# P(next role | role) when a turn ends, and P(role) of the first turn.
_NEXT = np.array([[0.02, 0.93, 0.05], [0.01, 0.06, 0.93], [0.01, 0.93, 0.06]])
_FIRST = np.array([0.30, 0.65, 0.05])
_ANYWHERE = np.array([0.04, 0.48, 0.48])
_END = 0.5
# P(feature | role) of blank, question, long.
_FEATURES = np.array([[0.10, 0.05, 0.40], [0.10, 0.30, 0.30], [0.12, 0.15, 0.50]])


def look(line: str) -> tuple[int, str, int] | None:
    """(way of writing, name, length) of a marker-like beginning; numbered speakers and tags have ways of their own."""
    for k, pattern in enumerate(_SYNTAX):
        m = pattern.match(line)
        if m:
            return k, m.group(1).lower(), m.end()
    m = _SPEAKER.match(line)
    if m:
        return len(_SYNTAX), "", m.end()
    return None


def style(found: list[tuple[int, str, int] | None]) -> set[tuple[int, str]]:
    """The (way, name) pairs that are markers in a transcript with these marker-like lines: of one way of
    writing, one name for each role.  Numbered speakers go with any style."""
    counts: dict[int, dict[str, int]] = {}
    for f in found:
        if f is not None and f[0] < len(_SYNTAX):
            counts.setdefault(f[0], {}).setdefault(f[1], 0)
            counts[f[0]][f[1]] += 1
    best, most = set(), (-1, 0)
    for way, names in counts.items():
        by_role = [[n for n in names if _ROLE_OF[n] == k] or [""] for k in range(3)]
        user, assistant = max(((u, a) for u in by_role[1] for a in by_role[2]),
                              key=lambda x: (names.get(x[0], 0) + names.get(x[1], 0), (x[0], x[1]) in _PAIRS))
        system = max(by_role[0], key=lambda n: names.get(n, 0))
        chosen = {n for n in (user, assistant, system) if n}
        score = (sum(names[n] for n in chosen), int((user, assistant) in _PAIRS))
        if score > most:
            best, most = {(way, n) for n in chosen}, score
    return best | {(len(_SYNTAX), "")}


def read_lines(transcript: str, escaped: bool = False) -> list[tuple[int, str, tuple[bool, bool, bool], str | None]]:
    """Marker, line without it, its features and, of a tag, the name, for each line."""
    lines = transcript.split("\n")
    plain = [escaped and line.startswith("\\") for line in lines]  # escaped: text, whatever it looks like
    tags = [_TAGGED.match(line) if escaped and not p else None for line, p in zip(lines, plain, strict=True)]
    found = [None if p else look(line) for line, p in zip(lines, plain, strict=True)]
    own = style(found)
    out = []
    for line, p, tag, f in zip(lines, plain, tags, found, strict=True):
        marker, name = CONTINUED if escaped and out else NO_MARKER, None
        if p:
            line = line[1:]
        elif f is not None and f[:2] in own:
            marker, line = SPEAKER if f[0] == len(_SYNTAX) else _ROLE_OF[f[1]] + CERTAIN * escaped, line[f[2]:]
        elif tag is not None:
            marker, name, line = NAMED, unquote_plus(tag.group(1)), line[tag.end():]
        out.append((marker, line, (not line.strip(), line.rstrip().endswith("?"), len(line) > 80), name))
    return out


def _moves() -> np.ndarray:
    move = np.full((6, 6), -np.inf)
    for r in range(3):
        for state in (r, r + 3):
            move[state, :3] = np.log(_END * _NEXT[r])
            move[state, r + 3] = np.log(1 - _END)
    return move


_MOVE = _moves()
# What may be before a transcript: one of the six states, the beginning of the conversation, or unknown turns.
BEGINNING, UNKNOWN = 6, 7
_ENTER = np.concatenate([_MOVE, [[*np.log(_FIRST), *[-np.inf] * 3], [*np.log(_ANYWHERE), *[-np.inf] * 3]]])


def _emissions(markers: list[np.ndarray], features: list[np.ndarray], longest: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(markers)
    emit = np.zeros((n, longest, 6))
    live = np.zeros((n, longest), bool)
    for k, (m, f) in enumerate(zip(markers, features, strict=True)):
        if len(m):
            shape = np.where(f[:, None, :], np.log(_FEATURES), np.log(1 - _FEATURES)).sum(2)
            emit[k, :len(m), :3] = np.log(_BEGIN[:, m].T) + shape
            emit[k, :len(m), 3:] = np.log(_GO_ON[m])[:, None] + shape
            live[k, :len(m)] = True
    return emit, live


def viterbi(markers: list[np.ndarray], features: list[np.ndarray], first: np.ndarray,
            enter: list[int | None] | None = None, leave: list[int | None] | None = None) -> list[np.ndarray]:
    """Likeliest states of each transcript: role + 3 * (goes on).  All transcripts advance together.  ``enter``
    and ``leave``: what is before a transcript (None: ``first``) and the state of its last line (None: the best)."""
    n, longest = len(markers), max((len(m) for m in markers), default=0)
    if longest == 0:
        return [np.zeros(0, np.int64) for _ in markers]
    emit, live = _emissions(markers, features, longest)
    score = np.full((n, 6), -np.inf)
    score[:, :3] = np.log(first)
    for k, state in enumerate(enter or []):
        if state is not None:
            score[k] = _ENTER[state]
    score = score + emit[:, 0]
    back = np.zeros((n, longest, 6), np.int8)
    for t in range(1, longest):
        all_ways = score[:, :, None] + _MOVE
        back[:, t] = all_ways.argmax(1)
        score = np.where(live[:, t, None], all_ways.max(1) + emit[:, t], score)
    out = []
    for k, m in enumerate(markers):
        path = np.zeros(len(m), np.int64)
        state = int(score[k].argmax()) if leave is None or leave[k] is None else leave[k]
        for t in range(len(m) - 1, -1, -1):
            path[t] = state
            state = int(back[k, t, state])
        out.append(path)
    return out


def passages(markers: list[np.ndarray], features: list[np.ndarray]) -> np.ndarray:
    """Per transcript, 8 x 6: the score of the best path from what may be before it to each state at its end.
    Each has a line at least."""
    emit, live = _emissions(markers, features, max((len(m) for m in markers), default=0))
    score = _ENTER[None] + emit[:, :1]
    for t in range(1, emit.shape[1]):
        ways = (score[:, :, :, None] + _MOVE).max(2) + emit[:, t, None]
        score = np.where(live[:, t, None, None], ways, score)
    return score


def chain(tables: np.ndarray, low: list[int], high: list[int]) -> list[tuple[int, int]]:
    """(what is before, state at the end) of each part on the best path through the passages of a conversation,
    whose parts have the turn numbers ``low`` to ``high``."""
    out: list[tuple[int, int]] = []
    cuts = [0, *[k for k in range(1, len(low)) if low[k] - high[k - 1] >= PART_TURNS], len(low)]
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        before = BEGINNING if x == 0 and low[0] < PART_TURNS else UNKNOWN
        score, back = tables[x, before], []
        for table in tables[x + 1:y, :6]:
            ways = score[:, None] + table
            back.append(ways.argmax(0).astype(np.int8))
            score = ways.max(0)
        states = [int(score.argmax())]
        for b in reversed(back):
            states.append(int(b[states[-1]]))
        states.reverse()
        out.extend(zip([before, *states[:-1]], states, strict=True))
    return out


def _read(transcripts: list[str | None], escaped: bool = False) -> tuple[list, list[np.ndarray], list[np.ndarray]]:
    lines = [read_lines(t, escaped) if t else [] for t in transcripts]
    return (lines, [np.array([x[0] for x in ls], np.int64) for ls in lines],
            [np.array([x[2] for x in ls], bool).reshape(len(ls), 3) for ls in lines])


def parse(transcripts: list[str | None], enter: list[int | None] | None = None, leave: list[int | None] | None = None,
          escaped: bool = False) -> list[list[tuple[str, str]]]:
    """Turns (role, text) of each transcript; ``enter`` and ``leave`` as in viterbi, ``escaped`` as ``transcripts_of`` writes."""
    lines, markers, features = _read(transcripts, escaped)
    out = []
    for ls, path in zip(lines, viterbi(markers, features, _FIRST, enter, leave), strict=True):
        turns: list[tuple[str, list[str]]] = []
        for (_, text, _, name), state in zip(ls, path.tolist(), strict=True):
            if state < 3 or not turns:
                turns.append((ROLES[state % 3] if name is None else name, [text]))
            else:
                turns[-1][1].append(text)
        out.append([(r, "\n".join(x)) for r, x in turns])
    return out


def render(turns: list[tuple[str, str]]) -> str:
    return "\n".join(f"<|{role}|>\n{text}\n<|end|>" for role, text in turns)


def _like_lengths(text: list[str | None]) -> Iterator[list[int]]:
    """Transcripts of like length advance together; a padded batch holds a bounded number of lines."""
    order = sorted(range(len(text)), key=lambda k: (text[k] or "").count("\n"))
    while order:
        longest = (text[order[-1]] or "").count("\n") + 1
        some = order[-max(1, 50_000 // longest):]
        del order[-len(some):]
        yield some


def format_transcripts(transcripts: DataFrame, id_cols: list[str], text_col: str = "transcript",
                       enter_col: str | None = None, leave_col: str | None = None, escaped: bool = False) -> DataFrame:
    """id_cols, n_turns, roles (comma-joined) and rendered for each transcript; the other columns as in viterbi,
    ``escaped`` as in parse."""
    state = lambda c: (F.col(c) if c else F.lit(None)).cast("int")
    rows = transcripts.select(*id_cols, F.col(text_col).alias("_t"), state(enter_col).alias("_e"), state(leave_col).alias("_l"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, enter, leave = (b.column(b.num_columns - k).to_pylist() for k in (3, 2, 1))
            parsed: list = [None] * len(text)
            for some in _like_lengths(text):
                for k, turns in zip(some, parse(*([x[k] for k in some] for x in (text, enter, leave)), escaped=escaped), strict=True):
                    parsed[k] = turns
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(len(id_cols))]
                + [pa.array([len(t) for t in parsed], pa.int64()), pa.array([",".join(r for r, _ in t) for t in parsed], pa.string()),
                   pa.array([render(t) for t in parsed], pa.string())], names=[*id_cols, "n_turns", "roles", "rendered"])

    ids = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:len(id_cols)])
    return rows.mapInArrow(run, f"{ids}, n_turns long, roles string, rendered string")


def _states(parts: DataFrame) -> DataFrame:
    """(key, at, enter, leave) of the transcripts (key, at, transcript, low, high) of conversations of several parts."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(2).to_pylist()
            tables: list = [None] * len(text)
            for some in _like_lengths(text):
                _, markers, features = _read([text[k] for k in some], escaped=True)
                for k, table in zip(some, passages(markers, features), strict=True):
                    tables[k] = table.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), b.column(4), pa.array(tables, pa.binary())],
                                             names=["key", "at", "low", "high", "passage"])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, rows):
            at, low, high, tables = (list(x) for x in zip(*rows, strict=True))
            both = chain(np.frombuffer(b"".join(tables)).reshape(-1, 8, 6), low, high)
            return pa.RecordBatch.from_arrays([pa.array([key] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array([x for x, _ in both], pa.int32()),
                                               pa.array([y for _, y in both], pa.int32())], names=["key", "at", "enter", "leave"])

        key, rows = None, []
        for b in batches:
            for k, *row in zip(*(b.column(c).to_pylist() for c in range(5)), strict=True):
                if rows and k != key:
                    yield out(key, rows)
                    rows = []
                key = k
                rows.append(row)
        if rows:
            yield out(key, rows)

    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (parts.select("key", "at", "transcript", "low", "high").mapInArrow(read, "key string, at long, low long, high long, passage binary")
            .repartition(n, "key").sortWithinPartitions("key", "at").mapInArrow(chained, "key string, at long, enter int, leave int"))


def _marker(style: Column, role: Column) -> Column:
    """How a turn's speaker is written in one of five styles of transcripts; in the last, by number only."""
    other = F.when(role == "", "Speaker 9: ").otherwise(F.concat(F.lit("<|"), F.url_encode(role), F.lit("|> ")))
    pick = lambda s, u, a: F.when(role == "system", s).when(role == "user", u).when(role == "assistant", a).otherwise(other)
    return (F.when(style == 0, pick("System: ", "User: ", "Assistant: ")).when(style == 1, pick("Context: ", "Human: ", "AI: "))
            .when(style == 2, pick("### System: ", "### Instruction: ", "### Response: "))
            .when(style == 3, pick("[system] ", "[user] ", "[assistant] ")).otherwise(pick("System: ", "Speaker 1: ", "Speaker 2: ")))


def transcripts_of(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, part, transcript, low, high): the turns written as transcripts, in a style that differs between conversations."""
    t = turns.select(F.col(id_col).alias("conv_id"), F.coalesce(F.col(turn_col).cast("long"), F.lit(0)).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    t = t.withColumns({"part": F.floor(F.col("turn") / PART_TURNS).cast("long"), "line": F.concat(_marker(style, F.col("role")), F.regexp_replace("text", _ESCAPED, "\n\\\\"))})
    rows = t.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "line"))).alias("x"),
                                          F.min("turn").alias("low"), F.max("turn").alias("high"))
    return rows.select("conv_id", "part", F.array_join(F.transform("x", lambda r: r["line"]), "\n").alias("transcript"), "low", "high")


def digest(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, roles and rendered_sha256 of the conversations, written as transcripts and parsed back."""
    # The key stands for the conversation as text, so that a null one is a key too.
    key = F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    number = F.floor(F.coalesce(F.col("turn").cast("long"), F.lit(0)) / PART_TURNS)
    several = (turns.groupBy(key.alias("several")).agg(F.min(number).alias("low"), F.max(number).alias("high")).where("low < high").select("several"))
    parts = transcripts_of(turns).withColumn("key", key)
    # Only turns of long conversations are written twice.
    long_ = transcripts_of(turns.join(several, key == F.col("several"), "left_semi")).select(key.alias("key"), F.col("part").alias("at"), "transcript", "low", "high")
    states = _states(long_).withColumnRenamed("key", "of")
    rows = parts.join(states, (F.col("key") == F.col("of")) & (F.col("part") == F.col("at")), "left")
    rows = rows.withColumn("enter", F.coalesce("enter", F.when(F.col("part") > 0, UNKNOWN).otherwise(BEGINNING)))
    out = format_transcripts(rows, ["conv_id", "part"], enter_col="enter", leave_col="leave", escaped=True)
    return out.select("conv_id", "part", "n_turns", "roles", F.sha2(F.col("rendered").cast("binary"), 256).alias("rendered_sha256"))


SQL = """
SELECT conv_id, CAST(floor(turn / 256) AS BIGINT) AS part, count(*) AS n_turns,
       string_agg(role, ',' ORDER BY turn, role, text) AS roles,
       sha256(string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>', chr(10) ORDER BY turn, role, text)) AS rendered_sha256
FROM conversations GROUP BY 1, 2
"""
