"""Chat formatting: the cheapest repair of a conversation's roles, rendered turn by turn."""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from dossier.checkpoints import freeze
from dossier.llm.tables import table

#: States of the automaton: before the first turn, and after a turn of each role.
ROLES = ("start", "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
#: Other spellings of roles, in lower case; what is not named here is an unknown role, code 0.
SPELLINGS = {"system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "prompter": USER,
             "assistant": ASSISTANT, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}
#: Which turn may follow which.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Costs of joining a turn to the one before, of an empty turn put in, of another role, and of a
#: role for a turn whose own is unknown.
MERGE, INSERT, RELABEL, NAME = 1, 2, 3, 1
#: A conversation ends with this role.
LAST = ASSISTANT
FAR = 1 << 40
HEAD, TAIL = "<|{role}|>\n", "<|end|>\n"


def _put_in(before: int, after: int) -> tuple[int, ...] | None:
    """The fewest empty turns that make ``after`` legal behind ``before``."""
    paths = [((), before)]
    for _ in ROLES:
        for path, at in paths:
            if after in LEGAL[at]:
                return path
        paths = [((*path, nxt), nxt) for path, at in paths for nxt in LEGAL[at]]
    return None


#: Per pair of states, the empty turns between them, or None.
BETWEEN = {(a, b): _put_in(a, b) for a in range(4) for b in range(1, 4)}


def _matrices() -> np.ndarray:
    """Cost of going from one state to another by a turn whose own role has each code."""
    out = np.full((4, 4, 4), FAR, np.int64)
    for code in range(4):
        for a in range(4):
            for b in range(1, 4):
                change = 0 if code == b else RELABEL if code else NAME
                steps = [MERGE] if a == b else []
                steps += [INSERT * len(BETWEEN[a, b])] if BETWEEN[a, b] is not None else []
                out[code, a, b] = change + min(steps) if steps else FAR
    return out


COSTS = _matrices()
ENDING = [() if s in (START, LAST) else (*BETWEEN[s, LAST], LAST) for s in range(4)]
END_COSTS = np.array([INSERT * len(e) for e in ENDING])


def path_cost(codes: list[int], roles: list[int]) -> int:
    """Cost of giving the turns of ``codes`` these roles."""
    states = [START, *roles]
    return int(sum(COSTS[c, a, b] for c, a, b in zip(codes, states, roles)) + END_COSTS[states[-1]])


def product_of(codes) -> np.ndarray:
    """Least cost from every state to every state over a run of turns."""
    total = np.where(np.eye(4, dtype=bool), 0, FAR)
    for code in codes:
        total = np.minimum((total[:, :, None] + COSTS[code][None]).min(axis=1), FAR)
    return total


def best_path(matrices: list[np.ndarray], enter: int, leave: int | None = None) -> list[int]:
    """The states after each of ``matrices`` on the cheapest path; of equal ones the lowest codes, from the end."""
    cost, back = np.full(4, FAR), []
    cost[enter] = 0
    for m in matrices:
        step = cost[:, None] + m
        back.append(step.argmin(axis=0))
        cost = step.min(axis=0)
    at = int((cost + END_COSTS).argmin()) if leave is None else leave
    states = []
    for b in reversed(back):
        states.append(at)
        at = int(b[at])
    return states[::-1]


def role_code(role: Column) -> Column:
    name = F.lower(F.trim(F.coalesce(role, F.lit(""))))
    out = F.lit(0)
    for spelling, code in SPELLINGS.items():
        out = F.when(name == spelling, code).otherwise(out)
    return out


def _numbered(batches):
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        places = np.arange(at, at + batch.num_rows)
        at += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int64)), pa.array(places)],
            [*batch.schema.names, "part", "pos"])


@F.pandas_udf(ArrayType(LongType()))
def _product(codes: pd.Series) -> pd.Series:
    return pd.Series([product_of(c).ravel() for c in codes])


@F.pandas_udf(ArrayType(LongType()))
def _states(products: pd.Series) -> pd.Series:
    return pd.Series([best_path([np.asarray(m).reshape(4, 4) for m in p], START) for p in products])


@F.pandas_udf(ArrayType(LongType()))
def _decoded(codes: pd.Series, enter: pd.Series, leave: pd.Series) -> pd.Series:
    return pd.Series([best_path([COSTS[c] for c in row], a, b) for row, a, b in zip(codes, enter, leave)])


_RENDERED = StructType([StructField(c, StringType()) for c in ("role", "action", "inserted", "rendered")])


@F.pandas_udf(_RENDERED)
def _rendered(code: pd.Series, before: pd.Series, after: pd.Series, last: pd.Series, text: pd.Series) -> pd.DataFrame:
    rows = [render(*row) for row in zip(code, before, after, last, text)]
    return pd.DataFrame(rows, columns=["role", "action", "inserted", "rendered"])


def render(code: int, before: int, after: int, last: bool, text: str | None) -> tuple[str, str, str, str]:
    """Role, action, empty turns put in and the rendered piece of one turn.

    The pieces of a conversation, one behind the other, are its rendered form.  Marks inside the
    text are broken up, so that no text can open or close a turn.
    """
    def empty(roles):
        return "".join(HEAD.format(role=ROLES[r]) + TAIL for r in roles)

    body = (text or "").replace("<|", "< |")
    between = BETWEEN[before, after]
    merged = before == after and (between is None or MERGE <= INSERT * len(between))
    put_in = () if merged else between
    piece = "\n" + body if merged else (TAIL if before != START else "") + empty(put_in) + HEAD.format(role=ROLES[after]) + body
    ending = ENDING[after] if last else ()
    if last:
        piece += TAIL + empty(ending)
    action = ("keep" if code == after else "relabel" if code else "name") + (" and merge" if merged else "")
    return ROLES[after], action, ",".join(ROLES[r] for r in (*put_in, *ending)), piece


def format_chats(turns: DataFrame) -> DataFrame:
    """Every turn with its repaired role and its piece of the rendered conversation.

    A conversation is repaired at the least total cost such that an optional system turn comes
    first, users and assistants take turns, a user begins and an assistant ends.  Turns are
    ordered by ``turn``, then role, then text; nulls come first.  No turn is lost: a null or empty
    text stays an empty turn, repeated rows are turns of their own, a null or unknown role is
    named at a small cost, and rows without a conversation id are one conversation.  An empty
    table gives an empty table; other columns are not read.

    Rows are dealt out by range of their order, so a long conversation spans many partitions.
    The costs of the automaton over a conversation's share of a partition are a 4 x 4 matrix; the
    matrices of a conversation, at most one a partition, give the states between its shares,
    and each share is then decoded on its own.
    """
    order = ["conv_id", "turn", "role", "text"]
    source = turns.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    kind = ", ".join(f"{c} {t}" for c, t in source.dtypes)
    rows = freeze(source.mapInArrow(_numbered, f"{kind}, part bigint, pos bigint"))
    shares = freeze(rows.groupBy("conv_id", "part").agg(
        F.array_sort(F.collect_list(F.struct("pos", role_code(F.col("role")).alias("code")))).alias("turns"))
        .select("conv_id", "part", F.col("turns.pos").alias("at"), F.col("turns.code").alias("codes")))
    whole = (shares.select("conv_id", "part", _product("codes").alias("product")).groupBy("conv_id")
             .agg(F.array_sort(F.collect_list(F.struct("part", "product"))).alias("shares"))
             .select(F.col("shares.part").alias("parts"), F.col("conv_id"), _states("shares.product").alias("states")))
    ends = whole.select("conv_id", F.posexplode(F.arrays_zip("parts", "states")).alias("k", "share"), "states").select(
        F.col("conv_id").alias("of"), F.col("share.parts").alias("part"),
        F.coalesce(F.get("states", F.col("k") - 1), F.lit(START)).alias("enter"),
        F.col("share.states").alias("leave"), (F.col("k") == F.size("states") - 1).alias("is_last"))
    decoded = (shares.join(ends, (shares["part"] == ends["part"]) & shares["conv_id"].eqNullSafe(ends["of"]))
               .select(shares["part"], "at", "codes", "enter", "is_last",
                       _decoded("codes", "enter", "leave").alias("roles")))
    each = decoded.select("part", F.posexplode(F.arrays_zip("at", "codes", "roles")).alias("k", "turn"), "enter",
                          "is_last", "roles").select(
        "part", F.col("turn.at").alias("pos"), F.col("turn.codes").alias("code"), F.col("turn.roles").alias("after"),
        F.coalesce(F.get("roles", F.col("k") - 1), "enter").alias("before"),
        (F.col("is_last") & (F.col("k") == F.size("roles") - 1)).alias("last"))
    piece = _rendered("code", "before", "after", "last", "text")
    return (rows.join(each, ["part", "pos"])
            .select("conv_id", "turn", F.col("role").alias("role_was"), piece.alias("piece"), "part", "pos")
            .select("conv_id", "turn", "role_was", "piece.*", F.struct("part", "pos").alias("place")))


def op9_chat_formatting(spark, sf_dir):
    return format_chats(table(spark, sf_dir, "conversations")).drop("place")
