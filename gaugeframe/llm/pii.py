"""Personal data by anchor expansion.

One Aho-Corasick pass over the text finds anchors: at-signs, plus signs, digits, schemes and
identifier cues. From an anchor a local parser reads outwards, forwards only past what it has
already read, so the work is linear in the text. The parsers of the four base kinds give the
leftmost non-overlapping matches of their patterns and then validate them; a match that fails
is dropped and not retried. Two kinds are added: ``address`` (a URL with a valid host) and
``account`` (an identifier with a digit that follows a cue such as ``token =``; after a blank only
it must have four digits; after ``iban`` and ``account`` it may stand in groups).
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.llm.text import in_parts

KINDS = ("email", "ip", "card", "phone", "address", "account")
BASE = 4
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]{1,5})?(?:[/?#][^\s\"'<>]*)?")
_SIGN = re.compile(r"[ \t]{0,3}[=:#][ \t]{0,3}[\"']?|[ \t]{1,3}[\"']?")
_VALUE = re.compile(r"[A-Za-z0-9_-]{6,}(?:\.[A-Za-z0-9_-]+)*")
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[ -]?[A-Za-z0-9]){11,30}")
_GROUPS = re.compile(r"[0-9]{2,}(?:[ -][0-9]{2,})+(?![A-Za-z0-9_])")
_SCHEMES = ("http://", "https://", "ftp://")
_CUES = ("account", "iban", "passport", "password", "secret", "ssn", "token", "api_key")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for word in _SCHEMES:
        for form in (word, word.upper()):
            found.add_word(form, ("scheme", len(form)))
    for word in _CUES:
        for form in (word, word.upper(), word.capitalize()):
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    return found


def passes_luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _small(part: str) -> bool:
    """At most 255, however many leading zeros."""
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _iban_end(text: str, at: int) -> int:
    """Where the longest IBAN from ``at`` on ends that passes its check; ``at`` if none does."""
    m = _IBAN.match(text, at)
    end = m.end() if m else at
    while end > at:
        code = text[at:end].replace(" ", "").replace("-", "")
        if len(code) < 15:
            break
        whole = end == len(text) or not (text[end].isascii() and text[end].isalnum())
        if whole and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            return end
        end -= 1
        while text[end - 1] in " -":
            end -= 1
    return at


def _value_span(text: str, cue: str, at: int) -> tuple[int, int] | None:
    """The identifier that follows a cue which ends at ``at``."""
    sign = _SIGN.match(text, at)
    if not sign:
        return None
    begin = sign.end()
    end = _iban_end(text, begin) if cue == "iban" else begin
    if end > begin:
        return begin, end
    for pattern in (_GROUPS, _VALUE) if cue in ("iban", "account") else (_VALUE,):
        m = pattern.match(text, begin)
        digits = sum(c in "0123456789" for c in m[0]) if m else 0
        least = 6 if pattern is _GROUPS else 1 if sign[0].strip(" \t\"'") else 4
        if digits >= least:
            return begin, m.end()
    return None


def find_spans(text: str, automaton) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` in code points, sorted; ends are exclusive."""
    out = []
    mail = dotted = card = phone = url = 0
    for last, (anchor, width) in automaton.iter(text):
        at = last + 1 - width
        if anchor == "digit":
            if at >= dotted:
                m = _DOTTED.match(text, at)
                dotted = m.end()
                if "." in m[0]:
                    parts, begin = m[0].split("."), at
                    for k in range(0, len(parts) - 3, 4):
                        four = parts[k : k + 4]
                        end = begin + sum(map(len, four)) + 3
                        if all(map(_small, four)):
                            out.append((begin, 1, end))
                        begin = end + 1
            if at >= card:
                m = _GROUPED.match(text, at)
                card = m.end() if m else at + 1
                if m and m.end() - at >= 12:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and passes_luhn(digits):
                        out.append((at, 2, m.end()))
        elif anchor == "at":
            begin = at
            while begin > mail and text[begin - 1] in _LOCAL:
                begin -= 1
            m = _DOMAIN.match(text, at + 1) if begin < at else None
            if m:
                out.append((begin, 0, m.end()))
                mail = m.end()
        elif anchor == "plus":
            m = _PHONE.match(text, at) if at >= phone else None
            if m:
                phone = m.end()
                if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    out.append((at, 3, m.end()))
        elif anchor == "scheme":
            m = _URL.match(text, last + 1) if at >= url else None
            if m:
                end = m.end()
                while text[end - 1] in ".,;:!?)":
                    end -= 1
                url = m.end()
                out.append((at, 4, end))
        elif at == 0 or not text[at - 1].isalnum():
            found = _value_span(text, text[at : last + 1].lower(), last + 1)
            if found:
                out.append((found[0], 5, found[1]))
    out.sort()
    return out


def named(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def masked(text: str, spans) -> str:
    """The text with each span replaced by its kind; overlapping spans by that of the first."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:] if out else text


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs (doc_id, text)``.

    ``n_email, n_ip, n_card, n_phone``, ``base_sha256`` (of the base spans written
    ``kind:start:end``, by start and then kind, comma-joined) and ``spans`` (all spans, written
    likewise). Positions count code points. A null text counts as empty; repeated rows get
    equal rows; other columns are not looked at.
    """
    schema = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS[:BASE]],
                        ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches):
        automaton = _automaton()
        for batch in in_parts(batches, 1):
            rows = []
            for text in batch.column(1).to_pylist():
                spans = find_spans(text, automaton) if text else []
                base = [s for s in spans if s[1] < BASE]
                kinds = [s[1] for s in base]
                rows.append((*map(kinds.count, range(BASE)),
                             hashlib.sha256(named(base).encode()).hexdigest(), named(spans)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                *[pa.array([r[k] for r in rows], schema.field(k + 1).type) for k in range(6)]],
                schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, spans string")


def mask_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``[KIND]``; null texts and other columns stay."""
    out = "__gf_masked"
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.StringType())])
    at = docs.columns.index(text)

    def run(batches):
        automaton = _automaton()
        for batch in in_parts(batches, at):
            new = [t and masked(t, find_spans(t, automaton))
                   for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(new, pa.string())],
                names=[*batch.schema.names, out])

    masks = docs.mapInArrow(run, schema)
    return masks.select(*[(F.col(out) if c == text else F.col(c)).alias(c) for c in docs.columns])
