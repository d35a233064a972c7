"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, digits, address schemes and identifier
cues. A deterministic parser of the anchor's kind then expands to both sides and validates:

* ``@``: an e-mail address, or ``user [at] host [dot] tld`` spelled out;
* a digit: a run of digits starts an IP address or a card number;
* ``+``: a phone number;
* ``http://``, ``https://``, ``ftp://``, ``ssh://``: an address that carries user data
  (``scheme://user:password@host``);
* ``iban``, ``account``, ``acct``, ``passport``, ``ssn``: an identifier after the cue, with IBAN's check digits,
  the field layout of a social security number, or 6 to 18 letters and digits holding at least 5
  digits.

Matches of a kind are leftmost and do not overlap. Base kinds (email, ip, card, phone) take
patterns with a validity test and no second attempt inside a failing match; the other kinds only
add spans where no base span lies.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tessera.llm.common import documents, prepare, slices, utf8

# fixed values: kinds in order, and the base kinds' patterns
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+").match
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)").match
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+").match
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").match

SCHEMES = ("http://", "https://", "ftp://", "ssh://")
CUES = ("iban", "account", "acct", "passport", "ssn")
USER_INFO = re.compile(r"[A-Za-z0-9._%+~-]+:[^\s/@:]+@[A-Za-z0-9.-]*[A-Za-z0-9]").match
LEAD = re.compile(r"(?:\x20?(?:number|no\.?|nr\.?|id))?\x20?[:#=]?\x20?", re.I).match
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])").match
SSN = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9])").match
IDENT = re.compile(r"[A-Z0-9](?:-?[A-Z0-9]){5,17}(?![A-Za-z0-9])").match
SPELLED_RIGHT = re.compile(r"\x20?[\])]\x20?[A-Za-z0-9-]+(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?[A-Za-z0-9-]+)+", re.I).match

Span = tuple[int, int, int]  # place of the kind in KINDS, start, end


@cache
def _automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for digit in "0123456789":
        a.add_word(digit, (1, "digit"))
    a.add_word("@", (1, "at"))
    a.add_word("+", (1, "plus"))
    for scheme in SCHEMES:
        a.add_word(scheme, (len(scheme), "scheme"))
    for cue in CUES:
        a.add_word(cue, (len(cue), cue))
    for spelled in ("[at]", "(at)", "[ at ]", "( at )"):
        a.add_word(spelled, (len(spelled), "spelled"))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def iban_valid(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign; its left side ends at ``floor``, where the last one ended."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    host = HOST(text, at + 1) if start < at else None
    return (start, host.end()) if host else None


def _user(text: str, bracket: int) -> int | None:
    """Where the user name in front of a bracket, and of one blank at most, begins. Brackets end names, so a text's names
    are read once."""
    end = bracket - (bracket > 0 and text[bracket - 1] == " ")
    start = end
    while start and text[start - 1] in LOCAL:
        start -= 1
    return start if start < end else None


def _identifier(text: str, end: int, cue: str) -> tuple[int, int] | None:
    at = LEAD(text, end).end()
    if cue == "iban":
        m = IBAN(text, at)
        return m.span() if m and iban_valid(m[0]) else None
    if cue == "ssn":
        m = SSN(text, at)
        return m.span() if m else None
    m = IDENT(text, at)
    return m.span() if m and len(only_digits(m[0])) >= 5 else None


def find(text: str) -> list[Span]:
    """All spans in code points, ends exclusive, by kind and start."""
    floor = dict.fromkeys(("email", "ip", "card", "phone"), 0)
    spans: list[Span] = []
    added: list[Span] = []
    lower = text.lower()
    if len(lower) != len(text):  # some letters grow in lower case; places must not move
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for last, (size, kind) in _automaton().iter(lower):
        start = last + 1 - size
        if kind == "digit":
            # a match starts at a run's first digit, or where the last match ended inside the run
            runs = start > 0 and "0" <= text[start - 1] <= "9"
            if start >= floor["ip"] and (not runs or start == floor["ip"]) and (m := IP(text, start)):
                floor["ip"] = m.end()
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                    spans.append((1, start, m.end()))
            if start >= floor["card"] and (m := CARD(text, start)):
                floor["card"] = m.end()
                digits = only_digits(m[0]) if m.end() - start >= 13 else ""
                if 13 <= len(digits) <= 19 and luhn(digits):
                    spans.append((2, start, m.end()))
        elif kind == "at":
            if start >= floor["email"] and (found := _email(text, start, floor["email"])):
                floor["email"] = found[1]
                spans.append((0, *found))
        elif kind == "plus":
            if start >= floor["phone"] and (m := PHONE(text, start)):
                floor["phone"] = m.end()
                if 9 <= len(only_digits(m[0])) <= 15:
                    spans.append((3, start, m.end()))
        elif kind == "scheme":
            if m := USER_INFO(text, last + 1):
                added.append((4, start, m.end()))
        elif kind == "spelled":
            user, right = _user(text, start), SPELLED_RIGHT(text, last)
            if user is not None and right:
                added.append((0, user, right.end()))
        elif not (start and (text[start - 1].isalnum() or text[start - 1] == "_")):
            if found := _identifier(text, last + 1, kind):
                added.append((5, *found))
    return _merge(spans, added)


def _merge(spans: list[Span], added: list[Span]) -> list[Span]:
    """``spans`` and those of ``added``, the first and longest first, that touch neither them nor one another: a sweep in order
    of places, with the furthest end of all base spans that start before one."""
    base = sorted((s, e) for _, s, e in spans)
    starts = [s for s, _ in base]
    furthest = list(itertools.accumulate((e for _, e in base), max))
    end = 0
    for span in sorted(added, key=lambda s: (s[1], -s[2], s[0])):
        before = bisect.bisect_left(starts, span[2])
        if span[1] >= end and not (before and furthest[before - 1] > span[1]):
            spans.append(span)
            end = span[2]
    return sorted(spans)


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def base_spans(text: str, spans: list[Span]) -> list[Span]:
    """The spans that the base patterns give: those of base kinds without spelled-out addresses."""
    return [s for s in spans if s[0] < len(BASE) and (s[0] or "@" in text[s[1]:s[2]])]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, found) for every row.

    ``found`` is an array of (kind, start, end, text). Counts are those of the base spans. Null and
    empty texts have no spans (the digest is that of the empty string); null ids and repeated rows
    are kept as they are; an empty table gives an empty result; other columns are ignored."""
    prepare(docs)
    counts = [f"n_{k}" for k in BASE]
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in counts) + (
        ", base_sha256 string, spans string, found array<struct<kind string, start int, end int, text string>>")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("text", pa.string())]))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body"):
            out: dict[str, list] = {c: [] for c in (*counts, "base_sha256", "spans", "found")}
            for body in batch.column("body").to_pylist():
                text = body.decode()
                spans = find(text)
                base = base_spans(text, spans)
                for i, c in enumerate(counts):
                    out[c].append(sum(s[0] == i for s in base))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(spans))
                out["found"].append([{"kind": KINDS[k], "start": s, "end": e, "text": text[s:e]}
                                     for k, s, e in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(out[c], pa.int64()) for c in counts),
                 pa.array(out["base_sha256"]), pa.array(out["spans"]), pa.array(out["found"], kind)],
                names=["doc_id", *out])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), utf8(F.col(text_col)).alias("body"))
    return rows.mapInArrow(work, schema)


def op4_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir)).drop("found")
