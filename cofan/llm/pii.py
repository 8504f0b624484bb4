r"""Personal data by anchor expansion.

One Aho-Corasick pass over a whole text, A-Z as a-z, finds anchors: at-signs, plus
signs, URL schemes and identifier cues.  Local parsers expand each anchor to the full
span and validate it.  Addresses and cards have no anchor: plain patterns of digit
runs find them in the whole text.

Base kinds, in order: email, ip, card, phone.  The method adds two kinds:

* url: a scheme that no letter or digit precedes, an optional user, a host (labels
  of at most 63 letters, digits and inner hyphens with a last label that begins with a
  letter, a dotted address, a bracketed one, or ``localhost``), an optional port up to 65535,
  then up to white space, a quote or an angle bracket.  Closing punctuation and
  brackets that the url does not open stay outside.
* account: what follows a cue that stands as a word, an optional ``no`` or ``number``
  and an optional ``:``, ``=`` or ``#``.  Each cue has a parser of its own: an IBAN has
  its country's length and right check digits, a social security number valid
  parts, a routing number and a health service number right check digits, a
  passport, bank code, tax and employer number their form; other identifiers are 6 to 34 letters
  and digits with at least 4 digits, single hyphens between them, and no date.

Spans are code points, end exclusive, leftmost and non-overlapping per kind; a base
match that fails its check is consumed, an added one leaves what follows to later
anchors.  Null text counts as empty and has no spans; repeated rows are scanned each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cofan.llm.common import in_slices, texts

KINDS = ("email", "ip", "card", "phone", "url", "account")
SCHEMES = ("http://", "https://", "ftp://")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is tried once, from its start: no later start in it can match.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE_RUN = re.compile(r"\+[0-9][\x20().0-9-]++")
URL_REST = re.compile(r"[^\x00-\x20\"'<>\x7f]*+")
AUTHORITY = re.compile(r"[^\x00-\x20\"'<>\x7f/?#(),;{}|\\^`]++")
LABEL = re.compile(r"[^\W_](?:[\w-]{0,61}[^\W_])?")
PAIRS = {")": "(", "]": "[", "}": "{"}
QUALIFIER = re.compile(r"\x20?(?i:no\.?|number)?\x20?[:=#]?\x20?")
IDENTIFIER = re.compile(r"[A-Za-z0-9](?:-?[A-Za-z0-9]){5,39}+(?!-?[A-Za-z0-9])")
DATE = re.compile(r"[12][0-9]{3}-[01][0-9]-[0-3][0-9]")
SSN = re.compile(r"(?!000|666|9)[0-9]{3}([\x20-]?)(?!00)[0-9]{2}\1(?!0000)[0-9]{4}(?![\x20-]?[0-9]|[A-Za-z])")
PASSPORT = re.compile(r"[A-Za-z]{0,2}[0-9]{6,9}[A-Za-z]?(?![A-Za-z0-9])")
BANK_CODE = re.compile(r"[A-Za-z]{6}[A-Za-z0-9]{2}(?:[A-Za-z0-9]{3})?(?![A-Za-z0-9])")
EMPLOYER = re.compile(r"[0-9]{2}-?[0-9]{7}(?!-?[0-9]|[A-Za-z])")
VAT = re.compile(r"[A-Za-z]{2}\x20?[A-Za-z0-9]{8,12}(?![A-Za-z0-9])")
NINE = re.compile(r"[0-9]{9}(?![A-Za-z0-9])")
TEN = re.compile(r"[0-9]{3}([\x20-]?)[0-9]{3}\1[0-9]{4}(?![\x20-]?[0-9]|[A-Za-z])")
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){11,30}")
# Lengths of an IBAN by country, as its public registry lists them.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22, DK=18, DO=28, EE=20,
    EG=29, ES=24, FI=18, FO=18, FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HR=21, HU=28, IE=22, IL=23, IQ=23, IS=26, IT=27, JO=30,
    KW=30, KZ=20, LB=28, LC=32, LI=21, LT=20, LU=20, LV=21, MC=27, MD=24, ME=22, MK=19, MR=27, MT=31, MU=30, NL=18, NO=15, PK=24, PL=28,
    PS=29, PT=25, QA=29, RO=24, RS=22, SA=24, SE=24, SI=19, SK=24, SM=27, TN=24, TR=26, UA=29, VA=22, VG=24, XK=20,
)
LOWER = {c: c + 32 for c in range(65, 91)}


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def lowered(text: str) -> str:
    """A-Z as a-z; every place stays where it is."""
    return text.lower() if text.isascii() else text.translate(LOWER)


def trimmed(text: str, start: int, end: int) -> int:
    """``end`` without closing punctuation and brackets that ``start`` to ``end`` does not open."""
    unopened = {c: text.count(c, start, end) - text.count(o, start, end) for c, o in PAIRS.items()}
    while end > start:
        c = text[end - 1]
        if unopened.get(c, 0) > 0:
            unopened[c] -= 1
        elif c not in ".,;:!?":
            break
        end -= 1
    return end


def is_host(host: str) -> bool:
    if host.startswith("[") and host.endswith("]"):
        try:
            return bool(ipaddress.IPv6Address(host[1:-1]))
        except ValueError:
            return False
    labels = host.removesuffix(".").split(".")
    if not all(map(LABEL.fullmatch, labels)):
        return False
    if all(x.isascii() and x.isdigit() for x in labels):
        return len(labels) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in labels)
    return host.lower() == "localhost" or len(labels) > 1 and len(labels[-1]) > 1 and labels[-1][0].isalpha()


def url_at(text: str, start: int, after: int) -> int:
    """End of the url whose scheme spans ``start`` to ``after``, else -1."""
    m = AUTHORITY.match(text, after)
    if not m or start and text[start - 1].isalnum():
        return -1
    more = text[m.end() : m.end() + 1] in ("/", "?", "#")
    end = m.end() if more else trimmed(text, after, m.end())
    host = text[after:end].rpartition("@")[2]
    port = re.search(r":([0-9]*)\Z", host)
    if port:
        host = host[: port.start()]
        if len(port[1]) > 5 or int(port[1] or 0) > 65535:
            return -1
    if not is_host(host):
        return -1
    return trimmed(text, after, URL_REST.match(text, end).end()) if more else end


def iban_at(text: str, at: int) -> int:
    m = IBAN.match(text, at)
    if not m:
        return -1
    size = IBAN_LENGTHS.get(m[0][:2].upper(), 0)
    places = [k for k, c in enumerate(m[0]) if c != " "]
    if not size or len(places) < size:
        return -1
    end = at + places[size - 1] + 1
    code = text[at:end].replace(" ", "").upper()
    right = int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1
    return end if right and not re.match(r"[A-Za-z0-9]", text[end : end + 1]) else -1


def form(pattern: re.Pattern[str], weights: tuple[int, ...] = (), modulus: int = 1) -> Callable[[str, int], int]:
    """A parser of ``pattern`` whose weighted digit sum is a multiple of ``modulus``."""

    def parse(text: str, at: int) -> int:
        m = pattern.match(text, at)
        digits = [int(c) for c in m[0] if c.isdigit()] if m and weights else []
        return m.end() if m and sum(w * d for w, d in zip(weights, digits)) % modulus == 0 else -1

    return parse


def identifier_at(text: str, at: int) -> int:
    m = IDENTIFIER.match(text, at)
    if not m or DATE.fullmatch(m[0]) or sum(c.isdigit() for c in m[0]) < 4:
        return -1
    return m.end() if len(m[0].replace("-", "")) <= 34 else -1


#: The parser of each cue: end of the identifier that begins at a place, else -1.
CUES: dict[str, Callable[[str, int], int]] = {
    "iban": iban_at,
    **dict.fromkeys(("ssn", "social security"), form(SSN)),
    "passport": form(PASSPORT),
    **dict.fromkeys(("swift", "bic"), form(BANK_CODE)),
    "ein": form(EMPLOYER), "vat": form(VAT), "tax id": identifier_at,
    **dict.fromkeys(("routing", "aba"), form(NINE, (3, 7, 1) * 3, 10)),
    "nhs": form(TEN, (10, 9, 8, 7, 6, 5, 4, 3, 2, 1), 11),
    **dict.fromkeys(("account", "acct", "a/c", "customer id", "user id", "member id", "employee id", "patient id"), identifier_at),
}


def account_at(text: str, start: int, after: int, cue: str) -> tuple[int, int]:
    """Span of the identifier behind the cue at ``start`` to ``after``, else (-1, -1)."""
    if start and text[start - 1].isalnum() or text[after : after + 1].isalnum():
        return -1, -1
    at = QUALIFIER.match(text, after).end()
    return (at, CUES[cue](text, at)) if at > after else (-1, -1)


def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in [("@", "email"), ("+", "phone"), *((s, "url") for s in SCHEMES), *((c, "account") for c in CUES)]:
        found.add_word(word, (kind, word))
    found.make_automaton()
    return found


def phone_at(text: str, start: int) -> int:
    """End of the phone pattern that begins at ``start``, else -1."""
    m = PHONE_RUN.match(text, start)
    if not m:
        return -1
    end = m.end()
    while end > start + 2 and not ("0" <= text[end - 1] <= "9"):
        end -= 1
    return end if end - start >= 4 else -1


def spans(text: str, found: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(kind index, start, end) of every span, sorted."""
    out: list[tuple[int, int, int]] = []
    done = dict.fromkeys(KINDS, 0)
    for last, (kind, word) in found.iter(lowered(text)):
        start, floor = last - len(word) + 1, done[kind]
        if start < floor:
            continue
        if kind == "email":
            left = start
            while left > floor and text[left - 1] in LOCAL:
                left -= 1
            m = DOMAIN.match(text, start + 1) if left < start else None
            if m:
                out.append((0, left, m.end()))
                done[kind] = m.end()
            elif left < start:
                done[kind] = start  # nothing left of this sign can belong to a later one
        elif kind == "phone":
            end = phone_at(text, start)
            if end > 0:
                done[kind] = end
                if 8 <= sum("0" <= c <= "9" for c in text[start:end]) <= 15:
                    out.append((3, start, end))
        elif kind == "url":
            end = url_at(text, start, last + 1)
            if end > 0:
                out.append((4, start, end))
                done[kind] = end
        else:
            at, end = account_at(text, start, last + 1, word)
            if end > 0:
                out.append((5, at, end))
                done[kind] = end
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    out.sort()
    return out


def shown(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in found)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, counts of the base kinds, their digest, and all spans."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ints = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS[:4]]
    schema = T.StructType([rows.schema["doc_id"], *ints, T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = anchors()
        for batch in in_slices(batches, "text"):
            every = [spans(t, found) for t in texts(batch.column("text"))]
            base = [[s for s in x if s[0] < 4] for x in every]
            counts = [pa.array([sum(s[0] == k for s in x) for x in base], pa.int64()) for k in range(4)]
            digests = [hashlib.sha256(shown(x).encode()).hexdigest() for x in base]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array(digests), pa.array([shown(x) for x in every], pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)
