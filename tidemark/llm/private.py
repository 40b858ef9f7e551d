"""Personal data in texts: patterns, and a character tagger that learns from what they find."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved
from tidemark.llm.tagger import Tagger, codes_of

KINDS = ("email", "ip", "card", "phone")
# Labels: 0 outside, then "begins" and "goes on" of each kind.
N_LABELS = 1 + 2 * len(KINDS)
WIDTH, STRIDE = 96, 48
# Bounds of the labelled sample: windows of each kind, and windows without personal data.
MAX_OF_KIND, MAX_OTHERS = 160, 480
DECODED_AT_ONCE = 512

# Every kind needs a digit or an at sign.
_ANCHOR = re.compile("[0-9@]")
_MAIL_END = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_MAIL_START = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _mails(text: str) -> Iterator[tuple[int, int]]:
    """From every at sign the letters before it, no further back than the last match; so the work
    is linear in the text."""
    last = 0
    at = text.find("@")
    while at >= 0:
        end = _MAIL_END.match(text, at)
        start = at
        while start > last and text[start - 1] in _MAIL_START:
            start -= 1
        if end and start < at:
            yield start, end.end()
            last = end.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find, in order."""
    found = []
    if "@" in text:
        found += [(s, 0, e) for s, e in _mails(text)]
    for m in _IP.finditer(text):
        if all(_octet(part) for part in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches within WIDTH / 2 code points of a digit or an at sign; nothing else can hold a span."""
    out: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        start, end = max(0, m.start() - STRIDE), min(len(text), m.start() + STRIDE)
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


_FOUND = (
    "doc_id long, spans array<struct<start:int,kind:int,end:int>>, "
    "regions array<struct<start:int,text:string,at_end:boolean>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans and regions of every text, at most a megabyte of regions in a batch."""
    span = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "kind", "end")]))
    region = pa.list_(pa.struct([("start", pa.int32()), ("text", pa.string()), ("at_end", pa.bool_())]))

    def batch_of(ids, spans, areas) -> pa.RecordBatch:
        arrays = [pa.array(ids, pa.int64()), pa.array(spans, span), pa.array(areas, region)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "spans", "regions"])

    for batch in batches:
        ids, spans, areas, size = [], [], [], 0
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            text = text.as_py() or ""
            own = base_spans(text) if _ANCHOR.search(text) else []
            around = regions(text)
            ids.append(doc)
            spans.append([{"start": s, "kind": k, "end": e} for s, k, e in own])
            areas.append(
                [{"start": s, "text": text[s:e], "at_end": e == len(text)} for s, e in around]
            )
            size += sum(e - s for s, e in around)
            if size > 1 << 20:
                yield batch_of(ids, spans, areas)
                ids, spans, areas, size = [], [], [], 0
        if ids:
            yield batch_of(ids, spans, areas)


def scanned(documents: DataFrame) -> DataFrame:
    """(doc_id, spans, regions) of every document, as a written table. Texts are read once."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return saved(rows.mapInArrow(_scan, _FOUND), "private-regions")


def cuts(length: int) -> list[int]:
    """Starts of the overlapping windows of a stretch of text."""
    if length <= WIDTH:
        return [0]
    return [*range(0, length - WIDTH, STRIDE), length - WIDTH]


def _undecided(text: str, low: int, spans: list[dict]) -> bool:
    """Whether digits look like a card but for the check digit, which is verified exactly later."""
    for m in _CARD.finditer(text):
        if 12 <= len(_NOT_DIGIT.sub("", m[0])) <= 19:
            place = (low + m.start(), low + m.end())
            if all((s["start"], s["end"]) != place for s in spans):
                return True
    return False


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows with the base spans that lie in them; kind is that of the first, or 4 for none.

    Left out are windows that cut a span, and those with digits that only a check tells from a card.
    """
    for batch in batches:
        kinds, texts, marks = [], [], []
        for spans, areas in zip(*(batch.column(n).to_pylist() for n in ("spans", "regions")), strict=True):
            for area in areas:
                for cut in cuts(len(area["text"])):
                    low = area["start"] + cut
                    text = area["text"][cut : cut + WIDTH]
                    high = low + len(text)
                    touched = [s for s in spans if s["start"] < high and s["end"] > low]
                    if any(s["start"] < low or s["end"] > high for s in touched):
                        continue
                    if not _ANCHOR.search(text) or _undecided(text, low, touched):
                        continue
                    kinds.append(touched[0]["kind"] if touched else len(KINDS))
                    texts.append(text)
                    marks.append(",".join(f"{s['kind']}:{s['start'] - low}:{s['end'] - low}" for s in touched))
        arrays = [pa.array(kinds, pa.int32()), pa.array(texts, pa.string()), pa.array(marks, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, ["kind", "text", "marks"])


def labelled_sample(found: DataFrame, of_kind: int = MAX_OF_KIND, others: int = MAX_OTHERS) -> DataFrame:
    """At most so many different windows of each kind, by the smallest hash."""
    rows = found.where("size(regions) > 0").select("spans", "regions")
    rows = rows.mapInArrow(_examples, "kind int, text string, marks string").distinct()
    rows = saved(rows, "private-windows")
    out = None
    for kind in range(len(KINDS) + 1):
        most = of_kind if kind < len(KINDS) else others
        part = rows.where(F.col("kind") == kind).orderBy(F.xxhash64("text"), "text", "marks").limit(most)
        out = part if out is None else out.unionByName(part)
    return saved(out, "private-sample")


def disguised(kind: int, span: str) -> str:
    """The span in a spelling that the patterns do not know."""
    if kind == 0:
        return span.replace("@", " @ ")
    if kind == 1:
        return span.replace(".", "[.]")
    if kind == 2:
        digits = _NOT_DIGIT.sub("", span)
        return ".".join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return "00" + span[1:]


def _labels(length: int, spans) -> np.ndarray:
    labels = np.zeros(length, np.int64)
    for kind, start, end in spans:
        labels[start:end] = 2 + 2 * kind
        labels[start] = 1 + 2 * kind
    return labels


def _padded(rows: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(rows), WIDTH), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def new_tagger() -> Tagger:
    allowed = np.ones((N_LABELS, N_LABELS), bool)
    opens = np.ones(N_LABELS, bool)
    for kind in range(len(KINDS)):
        inner = 2 + 2 * kind
        allowed[:, inner] = False
        allowed[[inner - 1, inner], inner] = True
        opens[inner] = False
    return Tagger(allowed, opens)


def training_rows(windows: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and labels of the windows, and of a disguised copy of each that has one span."""
    codes, labels = [], []
    for text, marks in windows:
        spans = [tuple(map(int, m.split(":"))) for m in marks.split(",") if m]
        codes.append(codes_of(text))
        labels.append(_labels(len(text), spans))
        if len(spans) == 1:
            kind, start, end = spans[0]
            other = disguised(kind, text[start:end])
            after = text[:start] + other + text[end:]
            if start + len(other) <= WIDTH:
                after = after[:WIDTH]
                codes.append(codes_of(after))
                labels.append(_labels(len(after), [(kind, start, start + len(other))]))
    return _padded(codes), _padded(labels)


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["kind", "text", "marks"])
    codes, labels = training_rows(list(zip(rows["text"], rows["marks"], strict=True)))
    return pd.DataFrame({"model": [new_tagger().fit(codes, labels).dumped()]})


def trained(sample: DataFrame) -> bytes | None:
    """The fitted weights, from one task over the bounded sample; None if nothing is labelled."""
    if sample.where(F.col("kind") < len(KINDS)).isEmpty():
        return None
    model = sample.groupBy(F.lit(0).alias("all")).applyInPandas(_fit, "model binary").first()
    return bytes(model["model"])


def plausible(kind: int, span: str) -> bool:
    """Whether a span of the tagger could be of its kind, read without spaces and brackets."""
    plain = re.sub(r"[\s\[\](){}]", "", span)
    digits = _NOT_DIGIT.sub("", span)
    if kind == 0:
        return list(_mails(plain)) == [(0, len(plain))]
    if kind == 1:
        match = _IP.fullmatch(plain)
        return match is not None and all(_octet(part) for part in plain.split("."))
    if re.search(r"[^0-9\s().+/-]", span):
        return False
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and span.startswith(("+", "00"))


def runs(labels: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the spans in a row of labels."""
    out, at = [], 0
    while at < len(labels):
        if labels[at]:
            kind, end = (int(labels[at]) - 1) // 2, at + 1
            while end < len(labels) and labels[end] == 2 + 2 * kind:
                end += 1
            out.append((kind, at, end))
            at = end
        else:
            at += 1
    return out


def reconciled(base, candidates, text_at) -> list[tuple[int, int, int]]:
    """Base spans and, of the windows' spans, those that lie deepest in their windows.

    A candidate is (margin, start, kind, end). Over the whole document they are taken by margin,
    and one that overlaps a taken span, or that is not plausible, is left out.
    """
    taken = sorted(base)
    own = []
    for _, start, kind, end in sorted(candidates, key=lambda c: (-c[0], c[1], c[2], c[3])):
        if all(end <= s or start >= e for s, _, e in own) and not _overlaps(taken, start, end):
            if plausible(kind, text_at(start, end)):
                own.append((start, kind, end))
    return sorted([*taken, *own])


def _overlaps(spans, start: int, end: int) -> bool:
    """Whether any span shares a code point with [start, end)."""
    return any(s < end and e > start for s, _, e in spans)


def _tagged(model: bytes | None):
    tagger = new_tagger().loaded(model) if model else None

    def windows_of(row) -> Iterator[tuple[int, bool, bool, str]]:
        for area in row["regions"]:
            starts = cuts(len(area["text"]))
            for cut in starts:
                first = area["start"] + cut == 0
                last = area["at_end"] and cut == starts[-1]
                yield area["start"] + cut, first, last, area["text"][cut : cut + WIDTH]

    def candidates(rows: list[dict]) -> list[list[tuple]]:
        found: list[list[tuple]] = [[] for _ in rows]
        waiting: list[tuple] = []

        def flush() -> None:
            labels = tagger.decode(_padded([codes_of(w[4]) for w in waiting]))
            for (i, at, first, last, text), row in zip(waiting, labels, strict=True):
                for kind, start, end in runs(row):
                    # A span at a window's edge may go on outside; another window holds it whole.
                    margin = min(WIDTH if first else start, WIDTH if last else len(text) - end)
                    if margin > 0:
                        found[i].append((margin, at + start, kind, at + end))
            waiting.clear()

        for i, row in enumerate(rows):
            for window in windows_of(row):
                waiting.append((i, *window))
                if len(waiting) == DECODED_AT_ONCE:
                    flush()
        if waiting:
            flush()
        return found

    def text_of(row):
        def text_at(start: int, end: int) -> str:
            for area in row["regions"]:
                if area["start"] <= start and end <= area["start"] + len(area["text"]):
                    return area["text"][start - area["start"] : end - area["start"]]
            return ""

        return text_at

    def whole(row, start: int, end: int) -> bool:
        """Whether no letter or digit stands right before or after the span."""
        for area in row["regions"]:
            low, text = area["start"], area["text"]
            if low <= start and end <= low + len(text):
                sides = text[max(0, start - low - 1) : start - low] + text[end - low : end - low + 1]
                return not any(c.isalnum() for c in sides)
        return False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = candidates(rows) if tagger else [[]] * len(rows)
            counts = [[] for _ in KINDS]
            digests, listed = [], []
            for row, own in zip(rows, found, strict=True):
                base = [(s["start"], s["kind"], s["end"]) for s in row["spans"]]
                own = [c for c in own if whole(row, c[1], c[3])]
                for kind in range(len(KINDS)):
                    counts[kind].append(sum(k == kind for _, k, _ in base))
                digests.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                listed.append(spans_text(reconciled(base, own, text_of(row))))
            arrays = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts)]
            arrays += [pa.array(digests, pa.string()), pa.array(listed, pa.string())]
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def personal_data(documents: DataFrame, of_kind: int = MAX_OF_KIND, others: int = MAX_OTHERS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans, one row per document.

    Patterns find the base spans. Windows around a bounded sample of them (``of_kind`` of each
    kind, ``others`` without any), and copies in which the span is spelled otherwise, train the
    tagger, which then reads every stretch near a digit or an at sign in overlapping windows; no
    kind can do without these characters. Its spans are added where they overlap no base span, do
    not cut a word, and are of valid form: four numbers up to 255, the check digit of a card, 9 to
    15 digits of a phone after + or 00, a whole address. They are at most 48 code points long.
    The counts and base_sha256 are of the base spans; ``spans`` lists all.

    NULL and empty texts have no spans. Very long texts are read whole; one text is held by one
    task. Repeated rows get a row each. Without any base span in the corpus nothing is added.
    Other columns are not read, whatever their names. An empty table gives no rows.
    """
    found = scanned(documents)
    model = trained(labelled_sample(found, of_kind, others))
    kind = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    return found.mapInArrow(_tagged(model), kind + "base_sha256 string, spans string")
