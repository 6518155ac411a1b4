"""Personal data: fixed patterns, and identifiers found by bootstrapped context.

The fixed patterns (e-mail, IP address, card and phone numbers) give the seeds. A seed's lexical context, the word next to
it on the left, on the right, on both sides, and the two words to the left, induces patterns; so do identifier-like words (those with a digit or an
at-sign) and runs of words of digits with single blanks between them that no fixed pattern explains: they are the candidates, and those shaped like a kind can
become one. Spark scores the graph between patterns and instances iteratively: a pattern is as good as the instances that stand in it, an instance as good as the patterns that it
stands in (noisy or). Seeds keep score 1; junk that stands in a pattern lowers it. Patterns that are high at the end, seen
with enough different seeds, label the candidates that stand in them.

Learned patterns are applied in a second pass over the whole texts, in blocks of at most
``BROADCAST_PATTERNS``, each broadcast for a pass of its own; one block as a rule.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.shared import dropped, lookup, written
from folioframe.llm.words import released

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A whole run of digits, and in the group what makes it an address: a run that is none is passed over at once.
_IP = re.compile(r"[0-9]++(\.[0-9]++\.[0-9]++\.[0-9]++)?")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
_SEPARATORS = frozenset(" \t\n\x0b\x0c\r")
#: What a candidate must look like to be of a kind; others only speak against a pattern.
SHAPES = {
    "email": re.compile(r"[^@]+@[^@]+"),
    "ip": re.compile(r"[0-9]+([.:][0-9]+){2,}"),
    "card": re.compile(r"[0-9]([.-]?[0-9]){11,18}"),
    "phone": re.compile(r"[(+]?[0-9]([().-]{0,2}[0-9]){6,14}"),
}
#: Words of digits, brackets, dots, hyphens and plus signs with single blanks between them.
_RUN = re.compile(r"(?<![0-9().+-])[0-9().+-]++(?: [0-9().+-]++)++")
_DOTTED = re.compile(r"[0-9]+(\.[0-9]+){2,}")
_EDGES = re.compile(r"^[^0-9A-Za-z+@]+|[^0-9A-Za-z]+$")
ROUNDS = 3
#: A pattern needs this score and so many different seeds.
PATTERN_SCORE, PATTERN_SEEDS = 0.9, 5
BROADCAST_PATTERNS = 200_000
#: Longer contexts and values are known by a digest of the whole.
WORD, VALUE = 40, 200


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int, str]]:
    """Addresses, outwards from each at-sign, so that long words cost no more than their length."""
    out, least, at = [], 0, text.find("@")
    while at >= 0:
        local = at - least - len(text[least:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            out.append((at - local, domain.end(), "email"))
        least = domain.end() if domain else at + 1
        at = text.find("@", least)
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind; linear in the length of the text."""
    out = _emails(text)
    for m in _IP.finditer(text):
        if m[1] and all(map(_small, m[0].split("."))):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() >= 14 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((m.start(), m.end(), "phone"))
    out.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return out


def _has_signs(texts: pa.Array) -> np.ndarray:
    """Texts with a digit or an at-sign: no other one can hold a span or a candidate."""
    return np.asarray(pc.fill_null(pc.match_substring_regex(texts, "[0-9@]"), False))


def _known(text: str, most: int) -> str:
    return text if len(text) <= most else f"\x1f{hashlib.md5(text.encode('utf-8', 'surrogatepass')).hexdigest()}"


def _bounds(spans: list[tuple[int, int, str]]) -> tuple[list[int], list[int]]:
    """Sorted starts and sorted ends: between these, contexts end."""
    return sorted(s for s, _, _ in spans), sorted(e for _, e, _ in spans)


def _context(text: str, start: int, end: int, bounds: tuple[list[int], list[int]] = ((), ())) -> list[str]:
    """The patterns around [start, end): left word, right word, both, and the two words to the left. A fixed span that is glued to the word ends it."""
    starts, ends = bounds
    z = start
    while z and text[z - 1] in _SEPARATORS:
        z -= 1
    a = z
    k = bisect_right(ends, start)
    least = ends[k - 1] if k and z == start and ends[k - 1] < start else 0
    while a > least and text[a - 1] not in _SEPARATORS:
        a -= 1
    left = _known(text[a:z].lower(), WORD) if a < z else "^"
    z = a
    while z and text[z - 1] in _SEPARATORS:
        z -= 1
    b = z
    while b and z < a and text[b - 1] not in _SEPARATORS:
        b -= 1
    far = _known(text[b:z].lower(), WORD) if b < z else "^"
    a = end
    while a < len(text) and text[a] in _SEPARATORS:
        a += 1
    z = a
    k = bisect_left(starts, end)
    most = starts[k] if k < len(starts) and a == end and starts[k] > end else len(text)
    while z < most and text[z] not in _SEPARATORS:
        z += 1
    right = _known(text[a:z].lower(), WORD) if a < z else "$"
    before = text[start - 1 : start] in ("", " ", "\n", "\t")
    after = text[end : end + 1] in ("", " ", "\n", "\t")
    left, right = left + (" " if before else ""), (" " if after else "") + right
    return [f"{left}\x1e_", f"_\x1e{right}", f"{left}\x1e_\x1e{right}", f"{far}\x1d{left}\x1e_"]


class _Taken:
    """Disjoint stretches that the spans cover."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for s, e in sorted(x[:2] for x in spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s), self.ends.append(e)

    def meets(self, start: int, end: int) -> bool:
        k = bisect_right(self.ends, start)
        return k < len(self.starts) and self.starts[k] < end


def candidate_runs(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Maximal runs of several words of digits that look like a kind and overlap no fixed span.

    A plus sign starts a run of its own, and so does a bracket but after a prefix of up to three digits.
    """
    out, used = [], _Taken(taken)

    def close(start: int, end: int) -> None:
        open_ = "(" in text[start:end]
        while end > start and not ("0" <= text[end - 1] <= "9" or text[end - 1] == ")" and open_):
            end -= 1
        if text[start] == "(" and text.find(")", start, end) == end - 1:  # brackets around all of it
            start, end = start + 1, end - 1
        if text.count("(", start, end) > text.count(")", start, end) and text[start] == "(":
            start += 1
        while start < end and text[start] not in "0123456789(+":
            start += 1
        if " " in text[start:end] and shape(text[start:end]):
            out.append((start, end))

    for m in _RUN.finditer(text):
        words, at = [], m.start()
        for w in m[0].split(" "):
            words.append((at, at + len(w)))
            at += len(w) + 1
        if m.start() and (text[m.start() - 1].isalnum() or text[m.start() - 1] in "@/_%"):
            words = words[1:]  # the end of a longer word
        if m.end() < len(text) and (text[m.end()].isalnum() or text[m.end()] in "@/_%"):
            words = words[:-1]
        start, end, digits = -1, -1, 0
        for a, z in words:
            alone = used.meets(a, z) or _DOTTED.fullmatch(text[a:z].strip("().+-")) is not None
            if start >= 0 and (alone or text[a] == "+" or text[a] == "(" and (digits > 3 or "(" in text[start:end])):
                close(start, end)
                start = -1
            if not alone:
                start, digits = (a, 0) if start < 0 else (start, digits)
                digits, end = digits + sum("0" <= c <= "9" for c in text[a:z]), z
        if start >= 0:
            close(start, end)
    return out


def candidate_spans(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Identifier-like words, without edge punctuation, that overlap no fixed span."""
    out, done, used = [], 0, _Taken(taken)
    for m in _SIGN.finditer(text):
        if m.start() < done:
            continue
        start, end = m.span()
        while start > done and text[start - 1] not in _SEPARATORS:
            start -= 1
        while end < len(text) and text[end] not in _SEPARATORS:
            end += 1
        word, done = text[start:end], end
        core = _EDGES.sub("", word)
        if len(core) < 2:
            continue
        start += word.index(core)
        end = start + len(core)
        if not used.meets(start, end):
            out.append((start, end))
    return out


def shape(word: str) -> str:
    """The first kind that the word looks like, or ''; of words with blanks between them, that of their digits and brackets."""
    if " " in word:
        word = re.sub(r"[ .-]", "", word)
    return next((k for k, p in SHAPES.items() if p.fullmatch(word)), "")


def _mentions(batches):
    """(kind or null, shape, value, pattern) of every seed and candidate."""
    for batch in batches:
        texts = batch.column(0)
        kinds, shapes, values, patterns = [], [], [], []
        for i in np.flatnonzero(_has_signs(texts)):
            text = texts[int(i)].as_py()
            base = base_spans(text)
            bounds, runs = _bounds(base), candidate_runs(text, base)
            inside = _Taken(runs)
            for start, end, kind in base:
                for p in _context(text, start, end, bounds):
                    kinds.append(kind), shapes.append(kind), values.append(_known(text[start:end], VALUE)), patterns.append(p)
            for start, end in runs + candidate_spans(text, base):
                like = shape(text[start:end])
                if not like and inside.meets(start, end):
                    continue  # a part of a run speaks against nothing
                for p in _context(text, start, end, bounds):
                    kinds.append(None), shapes.append(like), values.append(_known(text[start:end], VALUE)), patterns.append(p)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (kinds, shapes, values, patterns)], ["kind", "shape", "value", "pattern"])


def learn_patterns(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, score) of the high-confidence patterns of the whole corpus."""
    mentions = docs.select(F.col(text_col).alias("text")).mapInArrow(released(_mentions), "kind string, shape string, value string, pattern string")
    # an edge of the graph: a different value in a pattern
    edges = written(mentions.groupBy("pattern", "value", "kind", "shape").agg(F.count("*").alias("n")))
    # patterns that have seeds enough of one kind are all that can end high
    support = edges.filter("kind IS NOT NULL").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    best = support.groupBy("pattern").agg(F.max_by("kind", F.struct("seeds", "kind")).alias("best"), F.max("seeds").alias("seeds")).filter(F.col("seeds") >= PATTERN_SEEDS)
    graph = written(lookup(edges, best, "pattern").select("pattern", "best", "seeds", "value", "kind", "shape"))
    spark, score = docs.sparkSession, None
    dropped(spark, edges)
    for _ in range(rounds):
        own = graph.withColumn("instance", F.when(F.col("kind") == F.col("best"), 1.0).when(F.col("kind").isNotNull() | (F.col("shape") != F.col("best")), 0.0))
        if score is None:
            own = own.withColumn("instance", F.coalesce("instance", F.lit(0.0)))
        else:
            doubt = lookup(graph.filter("kind IS NULL"), score.select("pattern", "score"), "pattern").groupBy("value").agg((1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("score")))))).alias("value_score"))
            own = lookup(own, doubt, "value", "left").withColumn("instance", F.coalesce("instance", "value_score", F.lit(0.0)))
        before, score = score, written(own.groupBy("pattern", "best", "seeds").agg((F.sum("instance") / (F.count("*") + 0.25)).alias("score")).select("pattern", F.col("best").alias("kind"), "score"))
        if before is not None:
            dropped(spark, before)
    dropped(spark, graph)
    return score.filter(F.col("score") >= PATTERN_SCORE)


def _learned(text: str, base: list[tuple[int, int, str]], patterns: dict[str, str]) -> list[tuple[int, int, str]]:
    """Candidates that look like a kind and stand in one of its patterns; words within such a run are part of it."""
    if not patterns:
        return []
    out, bounds = [], _bounds(base)

    def add(spans):
        for start, end in spans:
            like = shape(text[start:end])
            if like and any(patterns.get(p) == like for p in _context(text, start, end, bounds)):
                out.append((start, end, like))

    add(candidate_runs(text, base))
    runs = _Taken(out)
    add(x for x in candidate_spans(text, base) if not runs.meets(*x))
    return out


def _written_spans(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def _read_spans(spans: str) -> list[tuple[int, int, str]]:
    return [(int(a), int(z), k) for k, a, z in (x.split(":") for x in spans.split(",") if x)]


def _all_spans(text: str, base: list, so_far: str, patterns: dict[str, str]) -> list[tuple[int, int, str]]:
    spans = {*base, *_read_spans(so_far), *_learned(text, base, patterns)}
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def _blocks(docs: DataFrame, text_col: str) -> list:
    """The learned patterns as broadcast dictionaries of bounded size."""
    patterns = learn_patterns(docs, text_col)
    n = patterns.count()
    blocks = max(1, -(-n // BROADCAST_PATTERNS))
    out = []
    for b in range(blocks):
        rows = patterns.filter(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == b).select("pattern", "kind").collect() if n else []
        out.append(docs.sparkSession.sparkContext.broadcast({r["pattern"]: r["kind"] for r in rows}))
    dropped(docs.sparkSession, patterns)
    return out


def _gather(patterns, at: int):
    """One more block of patterns: adds to the last column, the learned spans so far."""

    def work(batches):
        for batch in batches:
            texts, last = batch.column(at), batch.num_columns - 1
            so_far = batch.column(last).to_pylist()
            for i in np.flatnonzero(_has_signs(texts)):
                text = texts[int(i)].as_py()
                so_far[i] = _written_spans(sorted({*_read_spans(so_far[i]), *_learned(text, base_spans(text), patterns.value)}))
            yield batch.set_column(last, batch.schema.field(last), pa.array(so_far, pa.string()))

    return work


def _find(patterns):
    def work(batches):
        for batch in batches:
            texts, n = batch.column(1), batch.num_rows
            base, full = [""] * n, [""] * n
            counts = np.zeros((len(KINDS), n), dtype=np.int64)
            for i in np.flatnonzero(_has_signs(texts)):
                text = texts[int(i)].as_py()
                b = base_spans(text)
                base[i], full[i] = _written_spans(b), _written_spans(_all_spans(text, b, batch.column(2)[int(i)].as_py(), patterns.value))
                for _, _, k in b:
                    counts[KINDS.index(k), i] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c) for c in counts], pa.array(base, pa.string()), pa.array(full, pa.string())],
                ["id", *[f"n_{k}" for k in KINDS], "base", "spans"],
            )

    return work


def _redact(patterns, at: int):
    def work(batches):
        for batch in batches:
            texts = batch.column(at)
            hit = np.flatnonzero(_has_signs(texts))
            if len(hit):
                values = texts.to_pylist()
                for i in hit:
                    text = values[i]
                    parts, done = [], 0
                    for start, end, kind in _all_spans(text, base_spans(text), batch.column(batch.num_columns - 1)[int(i)].as_py(), patterns.value):
                        if end <= done:
                            continue
                        if start >= done:  # what overlaps the span before it is gone with it
                            parts += [text[done:start], f"<{kind.upper()}>"]
                        done = end
                    values[i] = "".join([*parts, text[done:]])
                batch = batch.set_column(at, batch.schema.field(at), pa.array(values, texts.type))
            yield batch.select(range(batch.num_columns - 1))

    return work


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_email, n_ip, n_card, n_phone (of the fixed patterns), base and spans of each row.

    ``base`` and ``spans`` list kind:start:end by start, then kind, comma-joined (code points, end exclusive);
    ``spans`` has the learned ones too. Learned spans overlap no fixed one.

    * null or empty text: no spans; texts of any length are searched whole;
    * rows with equal ids are searched each; null ids are kept; repeated values count once for a pattern;
    * ties between kinds of a pattern go to the kind with more seeds, then to the later name;
    * other columns are ignored; an empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base string, spans string"
    *more, last = _blocks(docs, text_col)
    rows = rows.withColumn("learned", F.lit(""))
    for patterns in more:
        rows = rows.mapInArrow(_gather(patterns, 1), rows.schema)
    return rows.mapInArrow(released(_find(last)), schema).withColumnRenamed("id", id_col)


def redact_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with every span replaced by its kind in angle brackets; of overlapping spans the first one's.

    Null and empty texts, null and repeated ids, and empty tables stay as they are; texts of any length are searched whole; columns may have any name.
    """
    narrow = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema)
    at = docs.columns.index(text_col)
    *more, last = _blocks(docs, text_col)
    narrow = narrow.withColumn("learned", F.lit(""))
    for patterns in more:
        narrow = narrow.mapInArrow(_gather(patterns, at), narrow.schema)
    out = narrow.mapInArrow(released(_redact(last, at)), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
