"""Secret scan over an inverted index of trigrams, in DataFrame functions only.

Each rule is a regular expression. From its expression a Boolean query over trigrams is derived: an OR of ANDs of the
trigrams that every match must contain. The index lists, for each trigram of these queries, the rows that contain it
(in lower case); intersecting the lists gives a rule's candidates, and only they are matched against the expression.
A rule without a mandatory trigram is matched against every row while the index is built.

The text of candidates is fetched by a join. A bitmap of bounded size over the candidates' keys keeps most other
texts out of that exchange; it never drops a candidate. Matches and their places come from marking every match in the
text, splitting at the marks, and adding up the lengths of the parts, in code points.

Cases: a null text counts as empty and has no spans. Rows that repeat, with or without a doc_id, are scanned each.
Texts of any length are scanned whole; the two mark characters may occur in them. Empty table: empty result. Of several
groups of spans of one row none is dropped; where spans of different rules overlap, all are reported.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hash_bitmap, in_bitmap, marked_rows, slots_for, without, written

_OPEN, _CLOSE, _NEUTRAL = "\x01", "\x02", "\x03"
#: Entries of an array, and code points of a text, that are looked at together.
_BLOCK, _TEXT_BLOCK = 256, 1 << 14
SPANS = "array<struct<kind:string,start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """``pattern`` in Java syntax. A match counts if the part ``group`` of it has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", group=2, least=6),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    Rule("hex", "[0-9a-f]+", least=24),
)
#: What follows the first line of a private key: all up to its last line, which has the next five dashes; where that is
#: missing, lines of base64 (with real or escaped line feeds, or long runs beside each other) and of key headers. All
#: repeats are lazy or possessive ones of one step, which Java runs without recursion, so a key may have any length.
_KEY_BODY = (
    "(?:(?>[\\s\\S]*?-----)END [A-Z ]*PRIVATE KEY-----"
    "|(?:(?:\\s|\\\\[rn])++(?:[A-Za-z0-9+/=]{40,}|(?:Proc-Type|DEK-Info):[^\\r\\n\\\\]*|[A-Za-z0-9+/=]+(?![^\\r\\n\\\\])))*+){0,1}"
)
#: What the method adds: common public formats of keys and credentials. A rule that begins with a run of letters is tried
#: only where such a run begins, so that no text makes it look at the same letters again and again.
ADDED = (
    Rule("private", "-----BEGIN [A-Z ]*PRIVATE KEY-----" + _KEY_BODY),
    Rule("jwt", "(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\\.eyJ[A-Za-z0-9_-]{8,}+\\.[A-Za-z0-9_-]{8,}"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("bearer", "(?i:bearer)\\x20+([A-Za-z0-9._~+/=-]{20,})"),
    Rule("url", "(?<![a-z0-9+.-])[a-z][a-z0-9+.-]{0,30}+://[A-Za-z0-9._%-]++:[^\\s:/@]{3,}+@"),
)
RULES = BASE + ADDED  # spans that begin at one place come in this order

_FEW = 6  # letters of a class that are multiplied out like alternatives
_REPEAT = re.compile(r"(?:\{(\d+)(?:,(\d*))?\}|[*+?])[?+]?")  # greedy, lazy or possessive


def mandatory(pattern: str) -> list[list[str]] | None:
    """The trigrams that a match has, as an OR of ANDs, in lower case; None if some way to match has none.

    Reads literals, escapes, classes, groups, alternatives and repeats. Alternatives of literals are multiplied out;
    what may be absent or has several characters ends a literal run.
    """
    branches, at = _alternatives(pattern, 0)
    if at != len(pattern):
        raise ValueError(f"cannot read {pattern!r} from {at}")
    queries = []
    for runs in branches:
        grams = sorted({run[k : k + 3] for run in runs for k in range(len(run) - 2)})
        if not grams:
            return None
        if grams not in queries:
            queries.append(grams)
    return queries


def _alternatives(pattern: str, at: int) -> tuple[list[list[str]], int]:
    """Ways to match, each as its literal runs; a None between runs stands for anything. Until the end of the group."""
    ways: list[list[str]] = []
    while True:
        branch, at = _sequence(pattern, at)
        ways += branch
        if at < len(pattern) and pattern[at] == "|":
            at += 1
            continue
        return ways, at


def _sequence(pattern: str, at: int) -> tuple[list[list[str]], int]:
    """Each way is a list of runs; an empty last run says that the next literal begins a new one."""
    ways: list[list[str]] = [[""]]
    while at < len(pattern) and pattern[at] not in "|)":
        char = pattern[at]
        if char == "(":
            opened = re.compile(r"\((?:\?(?:[a-z]*:|[>=!]|<[=!]))?").match(pattern, at)
            parts, at = _alternatives(pattern, opened.end())
            at += 1
            if opened[0] in ("(?=", "(?!", "(?<=", "(?<!"):  # takes no characters
                parts = [["", ""]]
        elif char == "[":
            chosen = re.compile(r"\[\^?\]?(?:\\.|[^\]\\])*\]").match(pattern, at)
            at, letters = chosen.end(), chosen[0][1:-1].lower()
            parts = [[c] for c in letters] if letters.isalnum() and len(letters) <= _FEW else [["", ""]]
        elif char == "\\":
            code = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|(.))").match(pattern, at)
            at = code.end()
            parts = [[chr(int(code[1], 16))]] if code[1] else [["", ""]] if code[2].isalnum() else [[code[2]]]
        else:
            at += 1
            parts = [["", ""]] if char == "." else [[char.lower()]]
        repeat = _REPEAT.match(pattern, at)
        if repeat:
            at = repeat.end()
            least = int(repeat[1]) if repeat[1] else 1 if repeat[0][0] == "+" else 0
            if repeat[0][0] == "?":
                parts = [*parts, [""]]
            elif least == 0:
                parts = [["", ""]]
            else:  # once for sure, then anything
                parts = [[*part, ""] for part in parts]
        ways = [[*way[:-1], way[-1] + part[0], *part[1:]] for way, part in itertools.product(ways, parts)]
    return ways, at


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _before(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each of ``values`` (whole numbers) all in front of it joined, beginning with 0. In blocks, because an array
    that grows is copied at every step."""

    def running(block: Column) -> Column:
        return F.aggregate(block, F.array(F.lit(0)), lambda all_, v: F.array_append(all_, join(F.element_at(all_, -1), v)))

    def joined(blocks: Column) -> Column:
        starts = running(F.transform(blocks, lambda b: F.element_at(b, -1)))
        return _let(starts, lambda starts: F.flatten(
            F.transform(blocks, lambda b, i: F.transform(F.slice(b, 1, F.size(b) - 1), lambda v: join(F.element_at(starts, i + 1), v)))
        ))

    numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int"))
    blocks = F.transform(numbers, lambda b: running(F.slice(values, b * _BLOCK + 1, _BLOCK)))
    return F.when(F.size(values) > 0, _let(blocks, joined)).otherwise(F.array().cast("array<int>"))


def _marked_spans(text: Column, rule: Rule) -> Column:
    """Spans of a rule's matches in ``text``, in order, by marks around the matches."""
    safe = F.translate(text, _OPEN + _CLOSE, _NEUTRAL * 2)
    parts = F.split(F.regexp_replace(safe, f"({rule.pattern})", f"{_OPEN}$1{_CLOSE}"), _OPEN)

    def span(part: Column, start: Column) -> Column:
        match = F.substring_index(part, _CLOSE, 1)
        value = F.regexp_extract(match, rule.pattern.removeprefix(_lookbehind(rule.pattern)), rule.group) if rule.group else match
        found = F.struct(F.lit(rule.kind).alias("kind"), start.alias("start"), (start + F.char_length(match)).alias("end"))
        return F.when(F.char_length(value) >= rule.least, found)

    def spans(parts: Column) -> Column:
        first, marked = F.char_length(F.element_at(parts, 1)), F.slice(parts, 2, F.size(parts))
        starts = _before(F.transform(marked, lambda p: F.char_length(p) - 1), lambda a, b: a + b)
        return _let(starts, lambda starts: F.filter(
            F.transform(marked, lambda p, i: span(p, first + F.element_at(starts, i + 1))), lambda s: s.isNotNull()
        ))

    return _let(parts, spans).cast(SPANS)


def _lookbehind(pattern: str) -> str:
    """What a pattern asks of the text in front of it, which a match by itself does not show."""
    return re.match(r"(?:\(\?<!\[[^\]]*\]\))?", pattern)[0]


def _spans(text: Column, rule: Rule) -> Column:
    """Spans of a rule; texts without any match are told apart before anything is built."""
    sure = rule.pattern
    if rule.group == 0 and sure.endswith("]+") and rule.least > 1:
        # A run that is long enough has this many characters of the class at its end.
        head = len(re.match(r"[A-Za-z]*", sure)[0])
        sure = f"{sure[:-1]}{{{rule.least - head},}}"
    return F.when(text.rlike(sure), _marked_spans(text, rule)).otherwise(F.array().cast(SPANS))


def _queries(rules: tuple[Rule, ...]) -> dict[str, list[list[str]] | None]:
    return {rule.kind: mandatory(rule.pattern) for rule in rules}


def _key(docs_text: Column) -> list[Column]:
    """Rows are known by id and text hash: rows alike in both have the same spans."""
    return [F.col("doc_id").cast("bigint").alias("__id"), F.xxhash64(docs_text).alias("__hash")]


def index(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The inverted index: (gram, __id, __hash), a posting for each trigram of the rules' queries and row that has it."""
    grams = sorted({g for query in _queries(rules).values() for way in query or [] for g in way})
    text = F.coalesce(F.col("text"), F.lit(""))
    low = docs.select(*_key(text), F.lower(text).alias("low"))
    present = F.filter(F.array(*(F.when(F.contains("low", F.lit(g)), g) for g in grams)), lambda g: g.isNotNull())
    return low.select("__id", "__hash", F.explode(present).alias("gram"))


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(__id, __hash, kinds): rows in the intersection of the posting lists of some rule's query, with those rules."""
    have = postings.groupBy("__id", "__hash").agg(F.collect_set("gram").alias("grams"))
    kinds = [
        F.when(F.exists(F.array(*(F.array(*map(F.lit, way)) for way in query)), lambda way: F.size(F.array_except(way, F.col("grams"))) == 0), kind)
        for kind, query in _queries(rules).items()
        if query
    ]
    return have.select("__id", "__hash", F.filter(F.array(*kinds), lambda k: k.isNotNull()).alias("kinds")).where("size(kinds) > 0")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(__id, __hash, spans) for rows of ``docs`` with a span: spans by start, then in the order of the rules. A row
    for each key, however many rows of ``docs`` share it."""
    text, queries = F.coalesce(F.col("text"), F.lit("")), _queries(rules)
    full = [rule for rule in rules if queries[rule.kind] is None]
    indexed = [rule for rule in rules if queries[rule.kind] is not None]
    found = []
    if indexed:
        chosen = written(candidates(index(docs, tuple(indexed)), tuple(indexed)), "secret-candidates")
        slots = slots_for(chosen.count())
        bitmap = hash_bitmap(chosen, "__hash", slots).scalar()
        texts = docs.select(*_key(text), text.alias("__text")).where(in_bitmap(bitmap, F.col("__hash"), slots))
        verify = texts.alias("t").join(chosen.hint("merge").alias("c"), F.expr("t.__hash = c.__hash and t.__id <=> c.__id"))
        each = [F.when(F.array_contains("kinds", rule.kind), _spans(F.col("__text"), rule)).otherwise(F.array().cast(SPANS)) for rule in indexed]
        found.append(verify.select("t.__id", "t.__hash", F.concat(*each).alias("spans")))
    if full:
        found.append(docs.select(*_key(text), F.concat(*(_spans(text, rule) for rule in full)).alias("spans")))
    order = F.array(*(F.lit(rule.kind) for rule in rules))
    every = found[0] if len(found) == 1 else found[0].union(found[1])
    places = F.array_sort(F.flatten(F.collect_set("spans")), lambda a, b: F.when(
        (a["start"] != b["start"]), F.when(a["start"] < b["start"], -1).otherwise(1)
    ).otherwise(F.signum(F.array_position(order, a["kind"]) - F.array_position(order, b["kind"])).cast("int")))
    return every.where("size(spans) > 0").groupBy("__id", "__hash").agg(places.alias("spans"))


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, narrow: bool = False) -> DataFrame:
    """``docs`` (with ``narrow``: doc_id alone) and spans, an array that is empty where nothing was found."""
    found = scan(docs, rules).select(_row_key(F.col("__id"), F.col("__hash")).alias("key"), F.col("spans").alias("__spans"))
    key = _row_key(F.col("doc_id").cast("bigint"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    others, marked = marked_rows(docs, key, written(found, "secret-spans"))
    columns = [F.col("doc_id")] if narrow else without(docs, "spans")
    none = F.array().cast(SPANS)
    return others.select(*columns, none.alias("spans")).union(marked.select(*columns, F.coalesce("__spans", none).alias("spans")))


def _row_key(doc_id: Column, text_hash: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), text_hash.cast("string"))


def written_out(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each stretch that spans cover replaced by ``[SECRET]``. ``spans`` are ordered by start."""

    def cut(blocks: Column, begin: Column, end: Column) -> Column:
        """The code points from ``begin`` to ``end``, from the blocks that hold them."""
        def piece(k: Column) -> Column:
            at = F.greatest(begin - k * _TEXT_BLOCK, F.lit(0))
            return F.substring(F.element_at(blocks, k + 1), at + 1, F.least(end - k * _TEXT_BLOCK, F.lit(_TEXT_BLOCK)) - at)

        held = F.sequence(F.floor(begin / _TEXT_BLOCK).cast("int"), F.floor((end - 1) / _TEXT_BLOCK).cast("int"))
        return F.when(begin < end, F.array_join(F.transform(held, piece), "")).otherwise("")

    def replaced(blocks: Column) -> Column:
        reached = _before(F.transform(spans, lambda s: s["end"]), F.greatest)
        gaps = _let(reached, lambda reached: F.array_join(F.transform(spans, lambda s, i: F.when(
            s["start"] >= F.element_at(reached, i + 1), F.concat(cut(blocks, F.element_at(reached, i + 1), s["start"]), F.lit("[SECRET]"))
        ).otherwise("")), ""))
        return F.concat(gaps, cut(blocks, F.array_max(F.transform(spans, lambda s: s["end"])), F.char_length(text)))

    numbers = F.sequence(F.lit(0), F.floor(F.char_length(text) / _TEXT_BLOCK).cast("int"))
    blocks = F.transform(numbers, lambda k: F.substring(text, k * _TEXT_BLOCK + 1, F.lit(_TEXT_BLOCK)))
    return F.when(F.size(spans) > 0, _let(blocks, replaced)).otherwise(text)


def redacted_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every found secret replaced in the text, and n_chars as it is afterwards."""
    # The length is taken in a later step: beside a new column "text", that name in the lambdas would be the new text.
    scanned = with_spans(docs, rules).withColumn("text", redacted(F.col("text"), F.col("spans")))
    return scanned.select(*(
        F.when(F.size("spans") > 0, F.char_length("text").cast("bigint")).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns
    ))
