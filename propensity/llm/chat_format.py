"""Chat formatting: a hidden Markov model recovers the roles of transcript lines before canonical rendering.

States are a role with `begin` (first line of a turn) or `inside`.  A line is observed as the class of its speaker
marker, a length class, whether it ends in a question mark and whether it is blank.  Tables of shares are
counted on labelled transcripts; Viterbi then finds the best states of a whole conversation.

Conversations are worked in segments of SEGMENT turns.  A segment is a max-plus matrix: best score from any state
before it to any state at its end.  Matrices of SEGMENT neighbours are multiplied into one, level by level, until
a conversation is one matrix; then its best end state goes down again: each node, knowing the state before it
and at its end, fixes those of its parts.  So a conversation of any length gives the exact Viterbi path, and no
task ever gets more than SEGMENT parts of one conversation."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm.common import saved

ROLES = ("system", "user", "assistant", "tool")
STATES = 2 * len(ROLES)          # role * 2 + (0: begin, 1: inside)
SEGMENT = 64
# Speaker markers at the beginning of a line, by class (0 is none).
MARKERS = (
    (1, "system|sys|### system"),
    (2, "user|human|question|q|### instruction|### human|prompt"),
    (3, "assistant|ai|bot|answer|a|### response|### assistant|model"),
    (4, "tool|function|result|### tool"),
)
_MARKER = re.compile("|".join(rf"(?P<m{k}>(?:<\|?)?(?:{names})(?:\|?>|\s*:))" for k, names in MARKERS), re.I)
CLASSES = len(MARKERS) + 1
LENGTHS = (1, 60, 200, 600)      # bounds of the length classes in characters
OBSERVED = CLASSES * (len(LENGTHS) + 1) * 2


def observe(line: str) -> tuple[int, int]:
    """Code of a line's features, and the length of its marker."""
    m = _MARKER.match(line)
    kind = int(m.lastgroup[1:]) if m else 0
    rest = line[m.end():].strip() if m else line.strip()
    size = sum(len(rest) >= b for b in LENGTHS)
    return (kind * (len(LENGTHS) + 1) + size) * 2 + rest.endswith("?"), m.end() if m else 0


@dataclass
class ChatModel:
    """Log shares: start (STATES), step (STATES x STATES), seen (OBSERVED x STATES)."""
    start: np.ndarray
    step: np.ndarray
    seen: np.ndarray

    def moves(self) -> np.ndarray:
        """(STATES + 1) x STATES: the last row is the beginning of a conversation."""
        return np.vstack([self.step, self.start])


def segments(lines: DataFrame) -> DataFrame:
    """Transcript turns (conv_id, turn, role, text) to rows (conv_id, node, turns): SEGMENT turns in order each.

    Turns are numbered by their place in the conversation, whatever `turn` holds: a sort over all rows cuts a
    long conversation into runs, and the counts of the runs before give each run its first place."""
    rows = lines.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
                        F.lower(F.trim("role")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    rows = saved(rows.orderBy("conv_id", "turn", "text", "role").withColumn("at", F.monotonically_increasing_id()), "turns").withColumn("run", F.shiftright("at", 33))
    runs = rows.groupBy(F.col("conv_id").alias("c"), F.col("run").alias("r")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("c").orderBy("r").rowsBetween(Window.unboundedPreceding, -1))     # a row per run
    runs = runs.select("c", "r", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    placed = rows.join(runs, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("run") == F.col("r"))).withColumn("place", F.col("at") + F.col("shift"))
    return placed.groupBy("conv_id", F.floor(F.col("place") / SEGMENT).alias("node")).agg(F.sort_array(F.collect_list(F.struct("place", "turn", "text", "role"))).alias("turns"))


def _truth(turns: list[dict]) -> list[tuple[int, int]]:
    """(observation, state) of the lines of a labelled segment."""
    out = []
    for t in turns:
        if t["role"] in ROLES:
            for n, line in enumerate(t["text"].split("\n")):
                out.append((observe(line)[0], ROLES.index(t["role"]) * 2 + (n > 0)))
    return out


def _count(batches):
    start, step, seen = np.zeros(STATES, np.int64), np.zeros((STATES, STATES), np.int64), np.zeros((OBSERVED, STATES), np.int64)
    for batch in batches:
        for node, turns in zip(batch.column("node").to_pylist(), batch.column("turns").to_pylist()):
            path = _truth(turns)
            for o, s in path:
                seen[o, s] += 1
            for (_, a), (_, b) in zip(path, path[1:]):
                step[a, b] += 1
            if path and node == 0:
                start[path[0][1]] += 1
    flat = np.r_[start, step.ravel(), seen.ravel()]
    used = np.flatnonzero(flat)
    yield pa.record_batch([pa.array(used, pa.int64()), pa.array(flat[used])], names=["cell", "n"])


def fit_chat(transcripts: DataFrame) -> ChatModel:
    """Counts over all labelled transcripts given; turns with an unknown or null role are left out."""
    flat = np.zeros(STATES + STATES * STATES + OBSERVED * STATES)
    for r in segments(transcripts).mapInArrow(_count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():   # a fixed number of cells
        flat[r["cell"]] = r["n"]
    start, step, seen = np.split(flat, [STATES, STATES + STATES * STATES])
    step, seen = step.reshape(STATES, STATES), seen.reshape(OBSERVED, STATES)
    can = np.ones((STATES, STATES))
    can[:, 1::2] = 0                                   # a line inside a turn follows a line of that turn
    for r in range(len(ROLES)):
        can[2 * r:2 * r + 2, 2 * r + 1] = 1
    with np.errstate(divide="ignore"):
        first = np.log((start + 0.5) * (np.arange(STATES) % 2 == 0) / (start + 0.5).sum())
        moves = np.log((step + 0.5) * can / ((step + 0.5) * can).sum(1, keepdims=True))
    return ChatModel(first, moves, _emissions(seen.reshape(CLASSES, len(LENGTHS) + 1, 2, STATES)))


def _emissions(seen: np.ndarray) -> np.ndarray:
    """Log shares per observation and state: marker, length class and question mark taken as independent given the
    state.  Before any count a beginning line has its own role's marker or none, a line inside a turn none."""
    prior = np.full((CLASSES, STATES), 0.02)
    prior[0] = np.where(np.arange(STATES) % 2 == 0, 0.4, 0.92)
    for r in range(len(ROLES)):
        prior[r + 1, 2 * r] = 0.54
    marker = seen.sum((1, 2)) + 2 * prior
    length, question = seen.sum((0, 2)) + 0.5, seen.sum((0, 1)) + 0.5
    logs = [np.log(x / x.sum(0)) for x in (marker, length, question)]
    return (logs[0][:, None, None] + logs[1][None, :, None] + logs[2][None, None]).reshape(OBSERVED, STATES)


def _product(parts: list[np.ndarray]) -> np.ndarray:
    """Max-plus product of (STATES + 1) x STATES matrices of neighbours."""
    out = parts[0]
    for p in parts[1:]:
        out = (out[:, :, None] + p[None, :STATES, :]).max(1)
    return out


def _through(parts: list[np.ndarray], before: int, end: int) -> list[int]:
    """Best states at the end of each part, given the state before the first and at the end of the last."""
    best, came = parts[0][before], []
    for p in parts[1:]:
        both = best[:, None] + p[:STATES]
        came.append(both.argmax(0))
        best = both.max(0)
    path = [end]
    for c in reversed(came):
        path.append(int(c[path[-1]]))
    return path[::-1]


def _line_parts(turns, model: ChatModel):
    moves = model.moves()
    return [moves + model.seen[observe(line)[0]] for t in turns for line in t["text"].split("\n")]


def _leaf(model):
    def run(batches):
        for batch in batches:
            m = [_product(_line_parts(t, model.value)).tobytes() for t in batch.column("turns").to_pylist()]
            yield pa.record_batch([batch.column("conv_id"), batch.column("node"), pa.array(m, pa.binary())], names=["conv_id", "node", "matrix"])
    return run


def _up(batches):
    for batch in batches:
        m = [_product([np.frombuffer(p["matrix"]).reshape(STATES + 1, STATES) for p in parts]).tobytes() for parts in batch.column("parts").to_pylist()]
        yield pa.record_batch([batch.column("conv_id"), batch.column("node"), pa.array(m, pa.binary())], names=["conv_id", "node", "matrix"])


def _root(batches):
    for batch in batches:
        ends = [int(np.frombuffer(x).reshape(STATES + 1, STATES)[STATES].argmax()) for x in batch.column("matrix").to_pylist()]
        yield pa.record_batch([batch.column("conv_id"), batch.column("node"), pa.array([STATES] * len(ends), pa.int64()), pa.array(ends, pa.int64())], names=["conv_id", "node", "before", "end"])


def _down(batches):
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            ends = _through([np.frombuffer(p["matrix"]).reshape(STATES + 1, STATES) for p in r["parts"]], r["before"], r["end"])
            out += [(r["conv_id"], p["node"], b, e) for p, b, e in zip(r["parts"], [r["before"], *ends], ends)]
        yield pa.record_batch([pa.array([x[k] for x in out], pa.int64()) for k in range(4)], names=["conv_id", "node", "before", "end"])


def _render(model):
    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ends = _through(_line_parts(r["turns"], model.value), r["before"], r["end"])
                at, last = 0, r["before"]
                for t in r["turns"]:
                    text = t["text"].split("\n")
                    states = ends[at:at + len(text)]
                    at += len(text)
                    piece, roles = "", []
                    for line, s in zip(text, states):
                        roles.append(ROLES[s // 2])
                        begins = s % 2 == 0
                        if begins and last < STATES:
                            piece += "<|end|>\n"
                        piece += (f"<|{ROLES[s // 2]}|>\n" if begins else "\n") + line[observe(line)[1]:].strip()
                        last = s
                    out.append((r["conv_id"], t["turn"], roles[0], states[0] % 2 == 0, len(text), sum(x == t["role"] for x in roles), piece))
            yield pa.record_batch([pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string()))],
                                  names=["conv_id", "turn", "role_pred", "begins", "n_lines", "n_right", "rendered"])
    return run


def format_chat(transcripts: DataFrame, model: ChatModel) -> DataFrame:
    """Per distinct row of transcripts(conv_id, turn, role, text): role_pred of its first line, begins (whether a turn
    begins there), n_lines, n_right (lines whose role is the given one), rendered: its part of the canonical rendering.
    The parts of a conversation joined in order of turn, then `<|end|>`, are its whole rendering.

    Equal rows count once; a null text is one blank line, a null turn is turn 0, a null conv_id is a conversation of its
    own; turns with the same number are ordered by text.  role is only compared with, never used."""
    sent = transcripts.sparkSession.sparkContext.broadcast(model)
    leaves = saved(segments(transcripts), "segments")
    levels = [saved(leaves.mapInArrow(_leaf(sent), "conv_id long, node long, matrix binary"), "matrices")]

    def parents(of: DataFrame) -> DataFrame:
        return of.groupBy("conv_id", F.floor(F.col("node") / SEGMENT).alias("parent")).agg(F.sort_array(F.collect_list(F.struct("node", "matrix"))).alias("parts"))
    # every conversation's node 0 is its root once no other node is left on a level
    while not levels[-1].where("node <> 0").isEmpty():
        levels.append(saved(parents(levels[-1]).select("conv_id", F.col("parent").alias("node"), "parts").mapInArrow(_up, "conv_id long, node long, matrix binary"), "matrices"))
    states = levels[-1].mapInArrow(_root, "conv_id long, node long, before long, end long")
    for level in reversed(levels[:-1]):
        p, s = parents(level).alias("p"), states.alias("s")
        states = saved(p.join(s, F.expr("p.conv_id <=> s.conv_id AND p.parent = s.node")).select("p.conv_id", "p.parts", "s.before", "s.end")
                       .mapInArrow(_down, "conv_id long, node long, before long, end long"), "states")
    a, s = leaves.alias("a"), states.alias("s")
    return (a.join(s, F.expr("a.conv_id <=> s.conv_id AND a.node = s.node")).select("a.conv_id", "a.turns", "s.before", "s.end")
            .mapInArrow(_render(sent), "conv_id long, turn long, role_pred string, begins boolean, n_lines long, n_right long, rendered string"))


def as_transcripts(conversations: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text) written the way transcripts come: a style of speaker markers per
    conversation (one of them without any) and about one marker in eight missing."""
    style = F.pmod(F.xxhash64("conv_id", F.lit("style")), F.lit(5))
    bare = F.pmod(F.xxhash64("conv_id", "turn", F.lit("bare")), F.lit(8)) == 0
    role = F.lower(F.trim("role"))

    def one(user: str, assistant: str, system: str, tool: str):
        return F.when(role == "user", user).when(role == "assistant", assistant).when(role == "system", system).when(role == "tool", tool).otherwise("")
    marker = (F.when(style == 0, one("User: ", "Assistant: ", "System: ", "Tool: ")).when(style == 1, one("Human: ", "AI: ", "System: ", "Function: "))
              .when(style == 2, one("Q: ", "A: ", "System: ", "Result: ")).when(style == 3, one("<|user|>", "<|assistant|>", "<|system|>", "<|tool|>")).otherwise(""))
    return conversations.select("conv_id", "turn", "role", F.concat(F.when(bare, "").otherwise(marker), F.coalesce("text", F.lit(""))).alias("text"))
