"""URL filter: all glob rules run at once over each canonical URL as one bit-parallel automaton.

Every rule is a glob over ``.host/path?query`` (host in lower case, scheme and fragment dropped, a dot in front so
that ``*.example.org`` means the host and its subdomains). The globs are packed one after the other into 64-bit
words; a Shift-And step moves the states of all globs by one byte. A batch of URLs goes through numpy together.

Cases: a null URL, or one without ``://``, has empty host and path, no rule, and the default verdict. Repeated rows
are judged alike. An empty table gives an empty result. Output columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import without


@dataclass(frozen=True)
class Rule:
    """``action`` for a host, its subdomains and the paths that start with ``path``."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}**"


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
#: Globs that block a URL to which no rule applies.
BLOCKED_GLOBS = (
    "*pills**", "*casino**", "*poker**", "*-bets**", "*spam**", "*.ads-*", "*.ads-*/**", "*.ads.**", "*porn**", "*viagra**",
    "*malware**", "*phishing**",
)
OUTPUT = "host string, path string, rule string, verdict string"

_URL = re.compile(r"://([^/?#]*)([^?#]*)(\?[^#]*)?", re.S)
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host (A-Z lowered), path and query (with its ``?``); all empty without ``://``."""
    found = _URL.search(url or "")
    return (found[1].translate(_FOLD), found[2], found[3] or "") if found else ("", "", "")


class GlobAutomaton:
    """Shift-And over several words. ``*`` is a run without ``/`` or ``?``, ``**`` any run, ``?`` one byte that ``*``
    could take; all else stands for itself. A glob has to match the whole text.

    State i of a glob: its first i single-byte items have been read. ``step[c]`` has the states that may be entered
    on byte c, ``stay[c]`` those with a run that c prolongs. A glob's first state is in no ``step``, so the bit that
    the shift carries over from its neighbour dies.
    """

    def __init__(self, globs: tuple[str, ...]):
        step, stay, first, last, state = {}, {}, [], [], 0
        inner = [c for c in range(256) if c not in b"/?"]
        for glob in globs:
            first.append(state)
            for item in re.findall(rb"\*\*|.", glob.encode(), re.S):
                if item in (b"**", b"*"):
                    stay.setdefault(state, set()).update(range(256) if item == b"**" else inner)
                else:
                    state += 1
                    step[state] = inner if item == b"?" else [item[0]]
            last.append(state)
            state += 1
        self.words = max(1, -(-state // 64))
        self.step, self.stay = np.zeros((256, self.words), np.uint64), np.zeros((256, self.words), np.uint64)
        for masks, table in ((self.step, step), (self.stay, stay)):
            for at, chars in table.items():
                for c in chars:
                    masks[c, at // 64] |= np.uint64(1 << (at % 64))
        self.start = np.zeros(self.words, np.uint64)
        for at in first:
            self.start[at // 64] |= np.uint64(1 << (at % 64))
        self.last = [(at // 64, np.uint64(at % 64)) for at in last]

    def match(self, texts: list[str]) -> np.ndarray:
        """Boolean matrix, texts by globs."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        lengths = np.array([len(r) for r in raw], np.int64)
        order = np.argsort(-lengths, kind="stable")  # so that those not yet at their end are always the first
        sizes, data = lengths[order], np.frombuffer(b"".join(raw), np.uint8)
        begins = (np.cumsum(lengths) - lengths)[order]
        state = np.tile(self.start, (len(raw), 1))
        for at in range(int(sizes[0]) if len(raw) else 0):
            active = int(np.searchsorted(-sizes, -at, side="left"))
            now, chars = state[:active], data[begins[:active] + at]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (moved & self.step[chars]) | (now & self.stay[chars])
        found = np.empty((len(raw), len(self.last)), bool)
        for k, (word, bit) in enumerate(self.last):
            found[order, k] = (state[:, word] >> bit) & np.uint64(1) == 1
        return found


def filter_urls(
    pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES, blocked: tuple[str, ...] = BLOCKED_GLOBS,
    default: str = "allow",
) -> DataFrame:
    """``pages`` with host, path, rule and verdict. The longest rule that fits decides (of equally long ones the
    first in the list); where none fits, a blocked glob blocks, and ``default`` holds otherwise."""
    ranked = sorted(rules, key=lambda r: -len(r.name))
    automaton = GlobAutomaton((*(r.glob for r in ranked), *blocked))

    @F.pandas_udf(OUTPUT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            parts = [split_url(u) for u in urls]
            hits = automaton.match(["." + h + p + q for h, p, q in parts])
            rule = np.where(hits[:, : len(ranked)].any(1), hits[:, : len(ranked)].argmax(1), -1) if ranked else np.full(len(parts), -1)
            by_glob = np.where(hits[:, len(ranked) :].any(1), "block", default)
            yield pd.DataFrame({
                "host": [h for h, _, _ in parts],
                "path": [p for _, p, _ in parts],
                "rule": [ranked[k].name if k >= 0 else None for k in rule],
                "verdict": [ranked[k].action if k >= 0 else by_glob[i] for i, k in enumerate(rule)],
            })

    names = ("host", "path", "rule", "verdict")
    judged = pages.select("*", judge(F.col(f"`{url}`")).alias("__judged"))
    return judged.select(*without(pages, *names), *(F.col(f"__judged.{n}").alias(n) for n in names))
