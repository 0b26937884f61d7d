"""Personal data by anchor expansion: an Aho-Corasick automaton finds cues, local parsers expand and validate around them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import arrow_map

#: Kinds in the order that breaks ties between spans with one start.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "ipv6", "iban", "account", "secret")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"[^\s\x00-\x20<>\"'`{}|\\^]+")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_V6 = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
_AFTER_CUE = re.compile(r"(?:\s?(?:no|nr|number|num|id)\b)?[.\s]{0,2}[:#=]?\s{0,2}([0-9][0-9-]{4,32}[0-9])(?![0-9])", re.I)
#: Cues, in small letters, that name an account or an identifier in the text after them.
CUES = ("account", "acct", "a/c", "ssn", "passport", "konto", "compte", "cuenta", "tax id", "routing")
#: Cues of secrets: keys have 16 characters or more and a digit, passwords six or more; both follow a sign of assignment.
KEYS = ("token", "api_key", "api-key", "api key", "apikey", "secret", "access_key", "access-key", "access key", "private_key")
PASSWORDS = ("password", "passwd", "pwd")
_SIGN = re.compile(r"""["'`]?\s{0,3}(?:=>|:=|[:=])\s{0,3}""")
_QUOTED = re.compile(r"""(["'`])([^\s"'`]{4,})\1""")
_BARE = re.compile(r"""[^\s"'`<>,;(){}\[\]]+""")
_BEARER = re.compile(r"\s{1,3}([A-Za-z0-9_\-+/=.~]{20,})")
_KEY = re.compile(r"(?=[^0-9]*[0-9])[A-Za-z0-9_\-+/=.~]{16,}")
_LAST_DIGIT, _LAST_OTHER = re.compile(r"(?s).*[0-9]"), re.compile(r"(?s).*[^A-Za-z0-9_\-+/=.~]")
_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMES = ("http://", "https://", "ftp://")

_machine: ahocorasick.Automaton | None = None


def machine() -> ahocorasick.Automaton:
    """Every anchor with the parser that it calls, in small letters; texts are scanned in small letters too."""
    global _machine
    if _machine is None:
        found = ahocorasick.Automaton()
        for d in "0123456789":
            found.add_word(d, ("digit", 1))
        found.add_word("@", ("email", 1))
        found.add_word("+", ("phone", 1))
        for d in "0123456789abcdef":
            found.add_word(":" + d, ("ipv6", 2))
        found.add_word("::", ("ipv6", 2))
        for kind, cues in (("account", CUES), ("key", KEYS), ("password", PASSWORDS), ("bearer", ("bearer",)), ("iban", ("iban",)), ("url", SCHEMES)):
            for cue in cues:
                found.add_word(cue, (kind, len(cue)))
        found.make_automaton()
        _machine = found
    return _machine


def small(text: str) -> str:
    """The text in small letters, character by character, so that offsets stay."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_SMALL)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def iban(text: str) -> bool:
    """The ISO 7064 check of an account number without spaces."""
    if not 15 <= len(text) <= 34:
        return False
    turned = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


class _Bare:
    """The last unquoted value that was looked at. Cues inside it see its end, last digit and last character that no key
    has, so a long run of cues is read once."""

    def __init__(self, text: str) -> None:
        self.text, self.end = text, -1

    def at(self, start: int, key: bool) -> int:
        """The end of a value that starts here, less what closes a sentence; -1 if it is none: a key has 16 characters of
        its own alphabet or more and a digit, a password six of any."""
        if start >= self.end:
            m = _BARE.match(self.text, start)
            if not m:
                return -1
            self.end = m.end()
            self.stop = start + len(m[0].rstrip(".!?:"))
            digit, other = _LAST_DIGIT.match(self.text, start, self.stop), _LAST_OTHER.match(self.text, start, self.stop)
            self.digit, self.other = digit.end() - 1 if digit else -1, other.end() - 1 if other else -1
        fits = self.stop - start >= 16 and self.digit >= start > self.other if key else self.stop - start >= 6
        return self.stop if fits else -1


def _secret(text: str, cue: str, at: int, bare: _Bare) -> tuple[int, int] | None:
    """The value after a cue of a secret that ends before ``at``, however long it is."""
    if cue == "bearer":
        m = _BEARER.match(text, at)
        return m.span(1) if m and _KEY.fullmatch(text, *m.span(1)) else None
    sign = _SIGN.match(text, at)
    if not sign:
        return None
    start = sign.end()
    if q := _QUOTED.match(text, start):
        good = _KEY.fullmatch(text, *q.span(2)) if cue == "key" else len(q[2]) >= 6
        return q.span(2) if good else None
    end = bare.at(start, cue == "key")
    return (start, end) if end >= 0 else None


def _v6(text: str) -> bool:
    parts = text.split(":")
    return (text.count("::") == 1 and len(parts) <= 8) or (len(parts) == 8 and all(parts))


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every span, by start and then by kind; code points, ends exclusive.

    Each base kind is leftmost and non-overlapping within itself. ``past`` is where a kind's search goes on: the end
    of its last match, valid or not.
    """
    out: list[tuple[int, int, str]] = []
    past = dict.fromkeys(KINDS, 0)
    n, bare = len(text), _Bare(text)
    for last, (cue, length) in machine().iter(small(text)):
        at = last - length + 1
        if cue == "digit":
            if at >= past["card"] and (m := _CHAIN.match(text, at)):
                past["card"] = m.end()
                digits = [c for c in m[0] if c in _DIGIT]
                if 12 <= len(digits) <= 19 and luhn("".join(digits)):
                    out.append((at, m.end(), "card"))
            if at >= past["ip"] and (at == 0 or text[at - 1] not in _DIGIT or at == past["ip"]):
                if m := _QUAD.match(text, at):
                    past["ip"] = m.end()
                    if all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in m[0].split(".")):
                        out.append((at, m.end(), "ip"))
        elif cue == "email":
            start = at
            while start > past["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                out.append((start, m.end(), "email"))
                past["email"] = m.end()
        elif cue == "phone":
            if at >= past["phone"] and (m := _PHONE.match(text, at)):
                past["phone"] = m.end()
                if 9 <= sum(c in _DIGIT for c in m[0]) <= 15:
                    out.append((at, m.end(), "phone"))
        elif cue == "url":
            if at >= past["url"] and (m := _URL.match(text, last + 1)):
                end = m.end()
                while end > last + 1 and text[end - 1] in ".,;:!?)]*%$&#":
                    end -= 1
                if end > last + 1:
                    out.append((at, end, "url"))
                    past["url"] = end
        elif cue == "ipv6":
            start = at
            while start > past["ipv6"] and at - start < 40 and (text[start - 1] in _DIGIT or text[start - 1] in "abcdefABCDEF:"):
                start -= 1
            if (m := _V6.match(text, start)) and _v6(m[0]):
                out.append((start, m.end(), "ipv6"))
                past["ipv6"] = m.end()
        elif cue == "iban":
            start = last + 1
            while start < n and start - last < 4 and text[start] in " :.#":
                start += 1
            if start >= past["iban"] and (m := _IBAN.match(text, start)) and iban(m[0].replace(" ", "")):
                out.append((start, m.end(), "iban"))
                past["iban"] = m.end()
        elif cue == "account" and (at == 0 or not text[at - 1].isalnum()):
            m = _AFTER_CUE.match(text, last + 1)
            if m and m.start(1) >= past["account"]:
                out.append((m.start(1), m.end(1), "account"))
                past["account"] = m.end(1)
        elif cue in ("key", "password", "bearer") and last >= past["secret"] and (at == 0 or not text[at - 1].isalnum()):
            if span := _secret(text, cue, last + 1, bare):
                out.append((*span, "secret"))
                past["secret"] = span[1]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, past = [], 0
    for a, b, kind in spans:
        if a >= past:
            out += [text[past:a], f"[{kind.upper()}]"]
        past = max(past, b)
    return "".join([*out, text[past:]])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {k: [] for k in BASE}
        digests, all_spans = [], []
        for text in batch.column("text"):
            spans = find(text.as_py() or "")
            base = [s for s in spans if s[2] in BASE]
            for k in BASE:
                counts[k].append(sum(s[2] == k for s in base))
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            all_spans.append(joined(spans))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in BASE), pa.array(digests, pa.string()), pa.array(all_spans, pa.string())], ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the base spans), spans (all of them).

    Spans are kind:start:end in code points, by start and then by kind, joined by commas. Null and empty texts have no
    spans; null and repeated ids stay rows; other columns are ignored.
    """
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string"
    return arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), _found, schema)


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with personal data in ``text_col`` replaced by its kind; null texts stay null."""
    schema = docs.schema
    n = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if (t := x.as_py()) is None else masked(t, find(t)) for x in batch.column(n)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, batch.schema.field(n).type) if i == n else batch.column(i) for i in range(batch.num_columns)], schema=batch.schema)

    return arrow_map(docs, run, schema)
