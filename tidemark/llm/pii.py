"""Personal data in texts: exact base forms, and what a character tagger finds beyond them.

Base spans are read by the four forms of ``KINDS``. A bidirectional LSTM with CRF transitions
(``tagger.py``), trained from labelled spans, finds other spellings, and data that the base forms lose because
a neighbouring number runs into it. It reads overlapping windows around every trigger: a digit, an ``@`` or a
spelled-out one that a dot follows within 40 characters. Digits and marks are parts of every other kind, so what
``accepted`` could take elsewhere is a spelled-out address in another spacing only; it is not looked for. The spans of
all windows of a text are reconciled together: pieces cut by a window's border are joined, what its kind cannot be is dropped, and of overlapping ones the set of the highest total
score stays, found by weighted interval scheduling. Base spans always stay.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import tagger
from tidemark.llm.common import map_batches, ship, text_of, without

KINDS = ("email", "ip", "card", "phone")
CONTEXTS = 1_500  # places of texts, about, that the labelled spans for training are planted into
TEXTS = 3_000  # labelled training texts made from them
WIDTH = 80  # characters of a training text
NEAR, WINDOW, STEP = 40, 128, 64  # characters around a trigger; length and distance of windows
WORDS = 24  # no kind has more parts than this: 19 digits, or the parts of a spelled-out address
TOGETHER = 256  # windows decoded at once

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
AT, DOT = r"(?:\s*[\[(]\s*(?:at|AT|@)\s*[\])]\s*|\s+(?:at|AT)\s+)", r"(?:\s*[\[(]\s*(?:dot|DOT|\.)\s*[\])]\s*|\s+(?:dot|DOT)\s+)"
TRIGGER = re.compile(r"[0-9@]|[\[( ](?:at|AT)[\]) ](?=.{1,40}?(?:dot|DOT|\.))")
Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    """Whether the check digit fits: every second digit from the right counts double, less 9 above 9."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def byte_sized(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def digits_of(piece: str) -> str:
    return "".join(c for c in piece if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans ``(start, end, kind)`` of the base forms, by start, kind and end.

    Time is linear in the text: an email is read from its ``@`` to both sides instead of from each letter.
    """
    found: list[Span] = []
    at, taken = text.find("@"), 0
    while at >= 0:
        start = at
        while start > taken and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            taken = match.end()
            found.append((start, taken, 0))
        at = text.find("@", max(at + 1, taken))
    found += [(*m.span(), 1) for m in IP.finditer(text) if all(map(byte_sized, m.group().split(".")))]
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), 2))
    found += [(*m.span(), 3) for m in PHONE.finditer(text) if 10 <= len(digits_of(m.group())) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def accepted(text: str, start: int, end: int, kind: int) -> bool:
    """Whether a found span can be of its kind, and does not cut a word or number."""
    piece = text[start:end]
    if (start and text[start - 1].isalnum() and piece[0].isalnum()) or (end < len(text) and text[end].isalnum() and piece[-1].isalnum()):
        return False
    digits = digits_of(piece)
    if kind == 0:
        plain = re.sub(DOT, ".", re.sub(AT, "@", piece))
        return [(s[0], s[1]) for s in base_spans(plain) if s[2] == 0] == [(0, len(plain))]
    if kind == 1:
        parts = re.split(r"\s?(?:\[\.\]|\(\.\)|\.)\s?", piece)
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and byte_sized(p) for p in parts)
    if kind == 2:
        return 14 <= len(digits) <= 19 and not re.search("[^0-9 .-]", piece) and luhn(digits)
    shaped = not re.search(r"[^0-9 ().+/-]", piece) and piece.rfind("+") <= 0
    return shaped and 10 <= len(digits) <= 15 and (piece[0] == "+" or len(re.findall(r"[0-9]+", piece)) > 2)


def windows_of(text: str) -> list[tuple[int, int, bool, bool]]:
    """Windows ``(start, end, more before, more after)`` over the zones around all triggers."""
    zones: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - NEAR), min(len(text), m.end() + NEAR)
        if zones and a <= zones[-1][1]:
            zones[-1][1] = max(b, zones[-1][1])
        else:
            zones.append([a, b])
    out = []
    for a, b in zones:
        starts = [a, *range(a + STEP, max(a + 1, b - WINDOW + STEP), STEP)]
        out += [(s, min(b, s + WINDOW), s > a, s + WINDOW < b) for s in starts]
    return out


def trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and not (text[a].isalnum() or text[a] in "+(%_"):
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    return a, b


def fitting(text: str, start: int, end: int, kind: int) -> list[Span]:
    """What of a found piece can be of its kind: the longest runs of its words that are accepted, from the left."""
    words = [(start + m.start(), start + m.end()) for m in re.finditer(r"\S+", text[start:end])]
    out, first = [], 0
    while first < len(words):
        for last in range(min(len(words), first + WORDS) - 1, first - 1, -1):
            a, b = trimmed(text, words[first][0], words[last][1])
            if a < b and accepted(text, a, b, kind):
                out.append((a, b, kind))
                first = last
                break
        first += 1
    return out


def reconciled(text: str, pieces: list[tuple], base: list[Span]) -> list[Span]:
    """The added spans of a text, from what all of its windows found.

    ``pieces`` are ``(start, end, kind, score, cut before, cut after)``. Overlapping pieces of a kind of which one is cut
    by a border are one; others compete.
    """
    joined: list[list] = []
    for p in sorted(pieces):
        last = next((j for j in reversed(joined[-8:]) if j[2] == p[2] and p[0] <= j[1] and (j[5] or p[4])), None)
        if last is None:
            joined.append(list(p))
        else:
            last[5] = p[5] if p[1] >= last[1] else last[5]
            last[1], last[3] = max(last[1], p[1]), max(last[3], p[3])
    best: dict[Span, float] = {}
    for start, end, kind, score, _, _ in joined:
        for span in fitting(text, start, end, kind):
            part = score * (span[1] - span[0]) / (end - start)
            if part > 0:
                best[span] = max(part, best.get(span, 0.0))
    taken = sorted((a, b) for a, b, _ in base)
    begins, reach = [a for a, _ in taken], []
    for _, b in taken:
        reach.append(max(b, reach[-1] if reach else 0))
    free = []
    for (a, b, kind), score in best.items():
        before = bisect_right(begins, b - 1)  # base spans that begin before the end
        if not (before and reach[before - 1] > a):
            free.append((b, a, kind, score))
    free.sort()
    stops = [f[0] for f in free]
    total, choice = [0.0], []
    for n, (b, a, kind, score) in enumerate(free):
        earlier = bisect_right(stops, a, 0, n)
        take = total[earlier] + score
        choice.append((take > total[n], earlier))
        total.append(max(take, total[n]))
    out, n = [], len(free)
    while n:
        chosen, earlier = choice[n - 1]
        if chosen:
            b, a, kind, _ = free[n - 1]
            out.append((a, b, kind))
        n = earlier if chosen else n - 1
    return out[::-1]


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


# Labelled spans for training: planted into places of the corpus.


def _luhn_number(rng: Random, n: int) -> str:
    head = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(head + d for d in "0123456789" if luhn(head + d))


def _digits(rng: Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _word(rng: Random, least: int = 2, most: int = 9) -> str:
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(least, most)))


def planted(rng: Random, kind: int) -> str:
    """A made-up value of a kind in one of its spellings."""
    if kind == 0:
        name = _word(rng) + rng.choice(["", "", f".{_word(rng)}", f".{_digits(rng, 2)}", f"_{_word(rng)}", _digits(rng, 2)])
        host = [_word(rng) + rng.choice(["", _digits(rng, 1)]), *([_word(rng)] if rng.random() < 0.5 else []), rng.choice(["com", "org", "net", "de", "fr", "es", "io"])]
        at, dot = rng.choice([("@", "."), ("@", "."), (" at ", " dot "), (" at ", "."), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("(at)", "."), ("[at]", ".")])
        return name + at + dot.join(host)
    if kind == 1:
        return rng.choice([".", ".", ".", "[.]", "(.)"]).join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == 2:
        number = _luhn_number(rng, rng.choice([16, 16, 16, 15, 14, 19]))
        gap = rng.choice(["", "", "", " ", "-", "."])
        return gap.join(number[k : k + 4] for k in range(0, len(number), 4))
    a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    forms = [f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{_digits(rng, 2)} {a} {b} {c}", f"+{_digits(rng, 2)}-{a}-{b}{c}", f"00{_digits(rng, 2)} {a} {b} {c}", f"+{_digits(rng, 12)}"]
    return rng.choice(forms)


def decoy(rng: Random) -> str:
    """Numbers and marks that are no personal data."""
    hexes = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([18, 32, 40])))
    return rng.choice(
        [hexes, f'token = "{hexes}"', f"password={hexes[:18]}", "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)),
         f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}", f"version {rng.randint(1, 9)}.{rng.randint(0, 9)}", f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
         f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2030)}", _digits(rng, rng.randint(1, 9)), f"{rng.randint(1, 99)},{_digits(rng, 3)}.{_digits(rng, 2)}", f"@{_word(rng)}", "at", f"meet at {rng.randint(1, 12)}:{_digits(rng, 2)}"]
    )


def labelled(contexts: list[str], seed: int = 11) -> tuple[list[str], list[list[Span]]]:
    """Texts of ``WIDTH`` characters with planted values, and the spans of these."""
    rng = Random(seed)
    texts, spans = [], []
    for context in contexts:
        parts = re.split(r"(?<= )", context.ljust(WIDTH))
        text, found = "".join(parts[: rng.randint(0, max(1, len(parts) // 2))]), []
        for _ in range(rng.choice([1, 1, 2, 2, 3])):
            if rng.random() < 0.3:
                text += decoy(rng)
            else:
                kind = rng.randrange(len(KINDS))
                value = planted(rng, kind)
                found.append((len(text), len(text) + len(value), kind))
                text += value
            text += rng.choice([" ", " ", " ", ", ", ". ", "\n", " | ", f" {_word(rng)} ", "!! "])
        text = (text + "".join(parts[len(parts) // 2 :])).ljust(WIDTH)
        shift = rng.randint(0, max(0, min(len(text) - WIDTH, found[0][0] if found else 0)))
        texts.append(text[shift : shift + WIDTH])
        spans.append([(a - shift, min(b - shift, WIDTH), k) for a, b, k in found if a - shift < WIDTH])
    return texts, spans


def train_tagger(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> tagger.Weights:
    """Weights of the tagger, from spans planted into about ``CONTEXTS`` places of the texts, one in each text of
    a sample by the hash of the id. Without any text there are no weights. NULL texts count as empty."""
    count = docs.count()
    share = min(1.0, CONTEXTS / count) if count else 0.0
    body, hashed = text_of(text), F.xxhash64(F.col(f"`{id_column}`"), F.lit("context"))
    place = F.pmod(F.shiftright(hashed, 20), F.greatest(F.char_length(body) - WIDTH, F.lit(1))).cast("int") + 1
    chosen = docs.filter(F.pmod(hashed, F.lit(1 << 20)) < int(share * (1 << 20))).select(F.substring(body, place, F.lit(WIDTH)).alias("context"), hashed.alias("h"))

    def learn(table: pa.Table) -> pa.Table:
        contexts = [c for _, c in sorted(zip(table["h"].to_pylist(), table["context"].to_pylist()))]
        w = tagger.train(*labelled((contexts * (TEXTS // len(contexts) + 1))[:TEXTS]), len(KINDS))
        return pa.table({"name": list(w), "shape": [list(v.shape) for v in w.values()], "value": [v.ravel().astype(np.float64) for v in w.values()]})

    ship(docs.sparkSession)
    one = chosen.groupBy(F.lit(0).alias("all")).applyInArrow(learn, "name string, shape array<bigint>, value array<double>")  # CONTEXTS short strings
    return {r["name"]: np.array(r["value"], np.float32).reshape(r["shape"]) for r in one.collect()}


def find_pii(docs: DataFrame, weights: tagger.Weights, text: str = "text") -> DataFrame:
    """``docs`` with ``n_email, n_ip, n_card, n_phone`` (base spans), ``base`` and ``spans`` (all spans) as texts, and ``n_added``.

    Spans are ``kind:start:end`` in code points. NULL texts count as empty; without weights only
    base spans are found; an empty table gives an empty result; columns of ``docs`` called like a result are replaced.
    """
    counts = [f"n_{k}" for k in KINDS]
    source = without(docs, *counts, "base", "spans", "n_added")
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # of fixed size
    kinds = len(KINDS)

    def added(texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        pieces: list[list[tuple]] = [[] for _ in texts]
        waiting: list[tuple] = []

        def flush() -> None:
            waiting.sort(key=lambda x: x[2] - x[1])  # windows of like length pad little
            for k in range(0, len(waiting), TOGETHER):
                some = waiting[k : k + TOGETHER]
                for (row, a, b, before, after), (tags, lead) in zip(some, tagger.decode(shared.value, [texts[r][x:y] for r, x, y, _, _ in some], kinds)):
                    for s, e, kind in tagger.spans_of(tags):
                        pieces[row].append((a + s, a + e, kind, float(lead[s:e].sum()), before and s == 0, after and e == b - a))
            waiting.clear()

        for row, body in enumerate(texts):
            for window in windows_of(body):
                waiting.append((row, *window))
                if len(waiting) >= 16 * TOGETHER:
                    flush()
        flush()
        return [reconciled(body, p, s) if p else [] for body, p, s in zip(texts, pieces, base)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [str(v) if v is not None else "" for v in part.column(part.schema.get_field_index(text)).to_pylist()]
                base = [base_spans(t) for t in texts]
                more = added(texts, base) if shared.value else [[] for _ in texts]
                out = [pa.array([sum(s[2] == k for s in spans) for spans in base], pa.int64()) for k in range(kinds)]
                out += [pa.array(map(written, base)), pa.array([written([*b, *m]) for b, m in zip(base, more)]), pa.array(map(len, more), pa.int64())]
                yield pa.record_batch([*part.columns, *out], names=[*part.schema.names, *counts, "base", "spans", "n_added"])

    new = [*[T.StructField(c, T.LongType()) for c in counts], T.StructField("base", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_added", T.LongType())]
    return map_batches(source, run, T.StructType([*source.schema.fields, *new]))
