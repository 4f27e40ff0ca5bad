"""Secret scan by one combined deterministic automaton.

All rules are compiled into one minimal byte automaton (``automaton``) that
scans every whole text in one pass.  Where it accepts, the stretch between the
nearest resets (pairs of bytes that no match can contain) is read once more with the exact
expressions of the accepted rules, which give leftmost non-overlapping spans;
a span that fails its rule's length is dropped and not retried.

Edge cases: a null or empty text has no spans; repeated rows are scanned row
by row; very long texts are scanned whole; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import _text as T
from .automaton import Automaton, compile_rules, scan


class Rule(NamedTuple):
    kind: str
    automaton: str          # what the automaton looks for, length included
    exact: str              # leftmost non-overlapping search
    fold: bool = False      # letters in either case
    group: int = 0          # whose length counts
    least: int = 1
    base: bool = False


# The rules, base kinds first, in their order.  The automaton's
# form may ask for fewer characters than the rule: counters that run at the same
# time multiply its states, and the exact search decides anyway.  Stretches are cut
# where no exact expression can go on, whatever set of rules is used.
RULES = (
    Rule("assign",
         r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}""",
         r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         True, 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{3}", r"AKIA[A-Z0-9]+", False, 0, 18, True),
    Rule("hex", r"[0-9a-f]{16}", r"[0-9a-f]+", False, 0, 16, True),
    Rule("repo_token", r"gh[pousr]_[A-Za-z0-9]", r"gh[pousr]_[A-Za-z0-9]+", False, 0, 24),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]", r"xox[abprs]-[A-Za-z0-9-]+", False, 0, 15),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]",
         r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]+)?"),
)
BASE = tuple(r.kind for r in RULES if r.base)


@lru_cache(maxsize=4)
def automaton(rules: tuple[Rule, ...] = RULES) -> Automaton:
    return compile_rules([(r.automaton, r.fold) for r in rules], [(r.exact, r.fold) for r in rules])


@lru_cache(maxsize=4)
def _exact(rules: tuple[Rule, ...]) -> list[re.Pattern[bytes]]:
    return [re.compile(r.exact.encode(), re.IGNORECASE if r.fold else 0) for r in rules]


def find(texts: list[bytes], rules: tuple[Rule, ...] = RULES, a: Automaton | None = None) -> dict[int, list[tuple[int, int, int]]]:
    """Per text with secrets: (rule, start, end) in bytes, by start then rule."""
    a, exact = a or automaton(rules), _exact(rules)
    buf, at = T.flat(texts)
    where, mask = scan(a, buf)
    found: dict[int, list[tuple[int, int, int]]] = {}
    if not len(where):
        return found
    resets = a.reset_ends(buf) - 1
    gap = np.searchsorted(resets, where)  # the stretch of every accepting step
    data = buf.tobytes()
    first = np.flatnonzero(np.diff(gap, prepend=-1))
    for g, m in zip(gap[first].tolist(), np.bitwise_or.reduceat(mask, first).tolist(), strict=True):
        lo = int(resets[g - 1]) + 1 if g else 0
        hi = int(resets[g]) if g < len(resets) else len(data)
        for k, rule in enumerate(rules):
            if m >> k & 1:
                for x in exact[k].finditer(data, lo, hi):
                    if len(x.group(rule.group)) >= rule.least:
                        # a stretch may begin in an earlier text than the match
                        row = int(np.searchsorted(at, x.start(), side="right")) - 1
                        found.setdefault(row, []).append((k, x.start() - int(at[row]), x.end() - int(at[row])))
    for v in found.values():
        v.sort(key=lambda x: (x[1], x[0]))
    return found


def code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte offsets to code points; all spans begin and end with ASCII."""
    lead = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(k, int(lead[a]), int(lead[b])) for k, a, b in spans]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: its id, ``spans`` (array of kind, start, end in code
    points, by start then rule order)."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    a = automaton(rules)  # built once, sent with the tasks
    schema = T.schema([T.field(docs, id_col, id_col)], "spans array<struct<kind:string,start:bigint,end:bigint>>")

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = T.raw(batch.column(1))
        found = find(texts, rules, a)
        out = [[{"kind": rules[k].kind, "start": lo, "end": hi} for k, lo, hi in code_points(texts[i], found[i])]
               if i in found else [] for i in range(len(texts))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(span))], names=[id_col, "spans"])

    return T.map_groups(docs.select(id_col, text_col), fn, schema, text_col)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
           rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The documents, every secret replaced by ``mark``; overlapping spans are
    replaced as one.  All columns stay; ``length_col`` follows the new text.
    A null text stays null."""
    schema, a = docs.schema, automaton(rules)
    names = [f.name for f in schema]
    count = length_col if length_col in names else None

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        i = names.index(text_col)
        col = batch.column(i)
        texts = T.raw(col)
        found = find(texts, rules, a)
        if not found:
            return batch
        new = col.to_pylist()
        for r, spans in found.items():
            out, at = [], 0
            for _, lo, hi in spans:
                if lo >= at:
                    out += [texts[r][at:lo], mark.encode()]
                at = max(at, hi)
            new[r] = b"".join([*out, texts[r][at:]]).decode()
        return replaced(batch, names, {text_col: new} | ({count: lengths(batch, names.index(count), found, new)} if count else {}))

    return T.map_groups(docs, fn, schema, text_col)


def lengths(batch: pa.RecordBatch, i: int, rows, texts: list[str | None]) -> list:
    """The length column with the new lengths of the rows that changed."""
    old = batch.column(i).to_pylist()
    for r in rows:
        old[r] = len(texts[r])
    return old


def replaced(batch: pa.RecordBatch, names: list[str], new: dict[str, list]) -> pa.RecordBatch:
    arrays = [pa.array(new[n], batch.schema.field(i).type) if n in new else batch.column(i)
              for i, n in enumerate(names)]
    return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)


