"""Personal data: base patterns, and spans that a conditional random field adds."""

from __future__ import annotations

import bisect
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from .bpe import slices
from .common import fresh

KINDS = ("email", "ip", "card", "phone")
#: Base patterns. They match what the plain ones do, in time linear in the text: repeats are possessive,
#: and an ip starts at the first digit of its run, as later ones fail where that one does.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL_BACKWARDS = re.compile(r"[A-Za-z0-9._%+-]++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SPAN = "array<struct<start:int,ord:int,kind:string,end:int,base:boolean>>"

#: Carrier words of the labelled table: plain, capital, numbers, accents and odd signs.
CARRIERS = (
    "the", "report", "of", "Monday", "about", "42", "items", "was", "sent", "version", "2.0.", "price", "$19.99", "in", "2024,", "and", "NASA", "über", "élan", "page", "7", "(see",
    "note)", "A-12", "x", "1,000", "end.", "10:30", "3.14", "|", "###", "hello!!", "ISO-9001", "b64b244acde2e3b0", "C++", "3+4", "http://a.example/b", "e.g.", "1999-2003", "No.", "12345", "v1.2.3",
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def good_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def good_card(text: str) -> bool:
    digits = digits_of(text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def good_phone(text: str) -> bool:
    return 10 <= len(digits_of(text)) <= 15


def emails(text: str):
    """(start, end) of the email pattern's matches: from each ``@`` its domain forwards and its local part backwards.

    Local parts hold no ``@``, so no character is looked at more than twice.
    """
    free = at = 0  # free: end of the last match or sign, behind which a local part begins
    while (at := text.find("@", at)) >= 0:
        domain = DOMAIN.match(text, at + 1)
        local = LOCAL_BACKWARDS.match(text[free:at][::-1]) if domain else None
        if local:
            yield at - local.end(), domain.end()
        free = at = domain.end() if local else at + 1


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, kind order, kind, end) of the base kinds, by start, then kind."""
    out = [(start, 0, "email", end) for start, end in emails(text)]
    for order, pattern, good in ((1, IP, good_ip), (2, CARD, good_card), (3, PHONE, good_phone)):
        out += [(m.start(), order, KINDS[order], m.end()) for m in pattern.finditer(text) if good(m[0])]
    return sorted(out)


def labelled_table(size: int = 600, seed: int = 11) -> list[tuple[list[str], list[int]]]:
    """The small labelled table (tokens, labels): entities of each kind set into carrier words by a fixed seed."""
    rng = random.Random(seed)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 8)))

    def card() -> str:
        body = rng.choice("3456") + number(14)
        return body + next(c for c in "0123456789" if luhn(body + c))

    def entity(kind: str) -> list[str]:
        if kind == "email":
            return [f"{word()}{rng.choice(['.', '_', ''])}{rng.choice([word(), number(2)])}@{word()}{rng.choice(['', number(1)])}.{word()}{rng.choice(['.com', '.org', ''])}"]
        if kind == "ip":
            return [".".join(str(rng.randint(0, 255)) for _ in range(4))]
        if kind == "card":
            c = card()
            return rng.choice([[c], [c[:4], c[4:8], c[8:12], c[12:]], ["-".join([c[:4], c[4:8], c[8:12], c[12:]])]])
        area, line = number(3), f"{number(3)}-{number(4)}"
        return rng.choice([[f"+{number(1)}", f"({area})", line], [f"({area})", line], [f"{area}-{line}"], [f"+{number(2)}", area, number(3), number(4)], [f"+{number(11)}"], [f"{area}.{line.replace('-', '.')}"]])

    rows = []
    for _ in range(size):
        tokens, labels = [], []
        for part in range(rng.randint(1, 3)):
            for _ in range(rng.randint(0 if part else 1, 4)):
                plain = rng.choice(CARRIERS) if rng.random() < 0.6 else word()
                tokens.append(plain)
                labels.append(0)
            if rng.random() < 0.6:
                kind = rng.choice(KINDS)
                new = entity(kind)
                if rng.random() < 0.25:
                    new[-1] += rng.choice(",.;)")
                tokens += new
                labels += [1 + KINDS.index(kind)] * len(new)
        rows.append((tokens, labels))
    return rows


def train(table: list[tuple[list[str], list[int]]] | None = None, rounds: int = 100) -> crf.Crf:
    sentences = []
    for tokens, labels in table or labelled_table():
        _, _, shapes = crf.tokenize(np.frombuffer(" ".join(tokens).encode(), np.uint8))
        sentences.append((shapes, np.array(labels)))
    return crf.fit(sentences, rounds)


#: Exact checks on spans that the model proposes.
CHECKS = {
    "email": re.compile(r"(?<![^\s@<>()\[\],;:|])[^\s@<>()\[\],;:|]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){13,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?)?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"),
}


def checked(kind: str, start: int, piece: str):
    """Parts of a proposed piece that hold what its kind needs: (start, end)."""
    for m in CHECKS[kind].finditer(piece):
        ok = {"ip": good_ip, "card": good_card, "phone": good_phone, "email": lambda _: True}[kind](m[0])
        if ok:
            yield start + m.start(), start + m.end()


def model_spans(model: crf.Crf, texts: list[str]) -> list[list[tuple[int, int, str, int]]]:
    """Spans that the model finds in each text, after the exact check."""
    out: list[list[tuple[int, int, str, int]]] = [[] for _ in texts]
    blobs = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8)
    edges = np.cumsum([len(b) + 1 for b in blobs])
    starts, ends, shapes = crf.tokenize(data)
    if not len(starts):
        return out
    lines = np.flatnonzero(data == 10)
    line_of = np.searchsorted(lines, starts)
    heads = np.concatenate([[True], line_of[1:] != line_of[:-1]])
    labels = model.decode(shapes, heads)
    hit = np.flatnonzero(labels)
    if not len(hit):
        return out
    cut = np.concatenate([[True], (np.diff(hit) > 1) | (np.diff(labels[hit]) != 0) | heads[hit[1:]]])
    begin = np.flatnonzero(cut)
    finish = np.append(begin[1:], len(hit)) - 1
    last = passed = at = 0  # document, and its bytes and characters that are counted already
    for b, f in zip(hit[begin].tolist(), hit[finish].tolist(), strict=True):
        doc = int(np.searchsorted(edges, starts[b], side="right"))
        offset = int(edges[doc - 1]) if doc else 0
        blob, kind = blobs[doc], KINDS[labels[b] - 1]
        a, z = int(starts[b]) - offset, int(ends[f]) - offset
        if doc != last:
            last, passed, at = doc, 0, 0
        at += len(blob[passed:a].decode())
        passed = a
        out[doc] += [(s, KINDS.index(kind), kind, e) for s, e in checked(kind, at, blob[a:z].decode())]
    return out


def apart(spans: list[tuple[int, int, str, int]], base: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    """Spans that overlap none of ``base``, which is sorted: one look into its merged runs for each."""
    starts, ends = [], []
    for start, _, _, end in base:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return [s for s in spans if not (i := bisect.bisect_left(starts, s[3])) or ends[i - 1] <= s[0]]


def find_spans(model: crf.Crf, texts: list[str]) -> list[list[tuple[int, int, str, int, bool]]]:
    """Base spans, marked True, and model spans that overlap none of them, by start, then kind."""
    out = []
    for text, more in zip(texts, model_spans(model, texts), strict=True):
        base = base_spans(text)
        out.append(sorted([(*s, True) for s in base] + [(*s, False) for s in apart(more, base)]))
    return out


def redact(text: str, spans: list[tuple[int, int, str, int, bool]]) -> str:
    """The text with each run of overlapping spans put as the first one's kind in brackets."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, _, kind, end, _ = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][3])
        out += [text[at:start], f"[{kind.upper()}]"]
        at, i = end, i + 1
    return "".join(out) + text[at:]


def find_pii(docs: DataFrame, model: crf.Crf, text: str = "text", spans: str = "spans", redacted: str = "redacted") -> DataFrame:
    """Add ``spans`` (start, ord, kind, end, base; code points, by start) and ``redacted`` to each row.

    Null text counts as empty. Other columns stay, but for those two names, whatever their case.
    The model has a fixed size and is broadcast; texts never leave their row.
    """
    value = F.col(text)
    hold = fresh(docs, "t")
    docs = docs.withColumn(hold, value).drop(spans, redacted)
    columns = [c for c in docs.columns if c != hold]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("ord", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches):
        for batch in slices(batches, hold):
            texts = [v or "" for v in batch.column(hold).to_pylist()]
            found = find_spans(shared.value, texts)
            rows = pa.array([[dict(zip(("start", "ord", "kind", "end", "base"), s, strict=True)) for s in own] for own in found], span)
            clean = pa.array([redact(t, s) if s else t for t, s in zip(texts, found, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), rows, clean], names=[*columns, spans, redacted])

    schema = docs.drop(hold).select("*", F.lit(None).cast(SPAN).alias(spans), F.lit(None).cast("string").alias(redacted)).schema
    return docs.mapInArrow(run, schema)
