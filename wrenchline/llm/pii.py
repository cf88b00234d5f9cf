"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one pass: at-signs, plus
signs, digits, schemes and the cues of identifiers. At each anchor a local parser
expands to the boundaries of one kind of value and validates it. A parser never
looks at the text again that an earlier value of its kind covers, so the work is
linear in the length of the text.

Base kinds follow fixed patterns (see ``BASE``), leftmost and non-overlapping for
each kind; a value that fails its check is dropped and not tried again from a later
start. The method adds ``url``, ``iban``, ``secret`` and ``account`` spans; they may
overlap base spans and never remove one.

Rows: a null text is an empty one, which holds nothing. Repeated rows each get a
result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "iban", "secret", "account")
KINDS = BASE + ADDED
_ORDER = {kind: i for i, kind in enumerate(KINDS)}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_RUN = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[A-Za-z0-9.-]+(?::[0-9]{1,5})?(?:[/?#][^\s<>\"'`{}|\\^]*)?")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ASSIGNED = re.compile(r"[\"']?\s{0,4}[:=]\s{0,4}([\"']?)([A-Za-z0-9_./+=-]{16,})\1")
_ACCOUNT = re.compile(r"(?:\s{0,4}(?:number|no\.?|nr\.?|#)){0,2}\s{0,4}[:=#]?\s{0,4}([A-Za-z]{0,3}[0-9](?:[ -]?[0-9]){5,16})(?![0-9])")

#: What introduces a value of an added kind, lower case.
SCHEMES = ("http://", "https://", "ftp://", "www.")
SECRET_CUES = ("token", "secret", "password", "api_key", "apikey", "api key")
ACCOUNT_CUES = ("account", "passport", "iban", "ssn", "konto", "compte", "cuenta")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _byte(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def _iban_valid(text: str) -> bool:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    moved = plain[4:] + plain[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for sign in "@+0123456789":
        found.add_word(sign, ("digit" if sign.isdigit() else sign, 1))
    for kind, cues in (("scheme", SCHEMES), ("secret", SECRET_CUES), ("account", ACCOUNT_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


_FOUND: list = []


def spans(text: str) -> list[tuple[str, int, int]]:
    """All (kind, start, end) of a text, by start and then by kind; code points, end exclusive."""
    if not _FOUND:
        _FOUND.append(_automaton())
    out: list[tuple[str, int, int]] = []
    free = dict.fromkeys(KINDS, 0)  # where a value of the kind may begin
    for last, (anchor, length) in _FOUND[0].iter(text):
        at = last - length + 1
        if anchor == "digit":
            if at >= free["card"]:
                _card(text, at, free, out)
            if at >= free["ip"]:
                _ip(text, at, free, out)
        elif anchor == "@":
            _email(text, at, free, out)
        elif anchor == "+":
            _phone(text, at, free, out)
        elif anchor == "scheme":
            _url(text, at, last + 1, free, out)
        elif anchor == "secret":
            _after_cue("secret", _ASSIGNED, 2, text, last + 1, free, out)
        else:
            if not _iban(text, last + 1, free, out):
                _after_cue("account", _ACCOUNT, 1, text, last + 1, free, out)
    return sorted(out, key=lambda s: (s[1], _ORDER[s[0]], s[2]))


def _card(text, at, free, out) -> None:
    end = _RUN.match(text, at).end()
    free["card"] = end
    if end - at >= 14:
        digits = _only_digits(text[at:end]) if end - at <= 37 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", at, end))


def _ip(text, at, free, out) -> None:
    """Dotted numbers: groups of four parts from the left."""
    end = _CHAIN.match(text, at).end()
    free["ip"] = end
    parts = text[at:end].split(".")
    start = at
    for first in range(0, len(parts) - 3, 4):
        four = parts[first : first + 4]
        stop = start + sum(map(len, four)) + 3
        if all(map(_byte, four)):
            out.append(("ip", start, stop))
        start = stop + 1


def _email(text, at, free, out) -> None:
    start = at
    while start > free["email"] and text[start - 1] in _LOCAL:
        start -= 1
    domain = _DOMAIN.match(text, at + 1)
    if start < at and domain:
        out.append(("email", start, domain.end()))
        free["email"] = domain.end()
    elif at >= free["email"]:
        free["email"] = at + 1


def _phone(text, at, free, out) -> None:
    match = _PHONE.match(text, at) if at >= free["phone"] else None
    if match:
        free["phone"] = match.end()
        if match.end() - at <= 4096 or sum("0" <= c <= "9" for c in match.group()) <= 15:
            if 10 <= len(_only_digits(match.group())) <= 15:
                out.append(("phone", at, match.end()))


def _url(text, at, after, free, out) -> None:
    match = _URL.match(text, after) if at >= free["url"] else None
    if match and "." in match.group():
        end = match.end()
        while text[end - 1] in ".,;:!?)]*":
            end -= 1
        free["url"] = end
        if end > after:
            out.append(("url", at, end))


def _after_cue(kind, pattern, group, text, after, free, out) -> None:
    match = pattern.match(text, after)
    if match and match.start(group) >= free[kind]:
        free[kind] = match.end(group)
        out.append((kind, *match.span(group)))


def _iban(text, after, free, out) -> bool:
    gap = after
    while gap < len(text) and gap < after + 12 and text[gap] in " :=#\t":
        gap += 1
    match = _IBAN.match(text, gap)
    if match and gap >= free["iban"] and _iban_valid(match.group()):
        free["iban"] = match.end()
        out.append(("iban", *match.span()))
        return True
    return False


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


def mask(text: str | None) -> str | None:
    """The text with every value replaced by its kind; overlapping values become one, named by the first."""
    if text is None:
        return None
    out, at = [], 0
    for kind, start, end in spans(text):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SCHEMA = "doc_id {}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"


def digest(docs: DataFrame) -> DataFrame:
    """Per document: base counts, the digest of base spans, all spans, and how many of them are added kinds."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                rows = [spans(text or "") for text in batch.column("text").to_pylist()]
                base = [[s for s in row if s[0] in BASE] for row in rows]
                counts = [pa.array([sum(s[0] == k for s in row) for row in base], pa.int64()) for k in BASE]
                hashes = [hashlib.sha256(joined(row).encode()).hexdigest() for row in base]
                added = [len(row) - len(b) for row, b in zip(rows, base, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *counts, pa.array(hashes), pa.array(map(joined, rows)), pa.array(added, pa.int64())],
                    names=["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans", "n_added"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA.format(kind))
