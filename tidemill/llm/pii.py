"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemill.llm.rows import map_rows, texts

# fixed values: the base kinds in their order, then those that need a good score
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE = 4

_AT = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can only begin where a run of digits does: a later start in the same run meets the same rest
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")

#: words near a span that speak for it, and against any; in English, German, French and Spanish
FOR = {
    "email": "email mail contact write address kontakt schreiben adresse postfach courriel écrire contacter correo escribir contacto dirección".split(),
    "ip": "ip address host server login adresse rechner anmeldung serveur connexion hôte servidor conexión dirección".split(),
    "card": "card visa mastercard credit payment cvv expiry karte kreditkarte zahlung ablauf carte bancaire paiement crédit tarjeta crédito pago".split(),
    "phone": "phone call tel telephone mobile fax whatsapp telefon anruf anrufen handy rufnummer téléphone appeler appel portable teléfono llamar móvil llamada".split(),
    "iban": "iban account bank transfer bic swift konto überweisung bankverbindung compte virement banque cuenta transferencia banco".split(),
    "ssn": "ssn social security sozialversicherung sozialversicherungsnummer sécurité sociale seguridad".split(),
}
AGAINST = (
    "example sample test dummy fake version isbn order beispiel muster probe bestellung bestellnummer "
    "exemple échantillon essai factice commande ejemplo muestra prueba pedido versión"
).split()
WINDOW = 40
_WORD = re.compile(r"[^\W\d_]+")
#: score of a kind before context; checksums have passed by then
START = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.65, "ssn": 0.3}
LEAST_SCORE = 0.5


def luhn(digits: str) -> bool:
    """The mod-10 check of payment cards."""
    total = 0
    for place, d in enumerate(map(int, reversed(digits))):
        total += d if place % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The check of bank account numbers: moved behind, letters as two digits, the remainder is one."""
    rest = 0
    for c in code[4:] + code[:4]:
        value = int(c, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


@dataclass(frozen=True, order=True)
class Span:
    """Code points, end exclusive; ordered by start, then kind as listed."""

    start: int
    rank: int
    stop: int
    score: float

    @property
    def kind(self) -> str:
        return KINDS[self.rank]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # from the sign backwards, so a long run of letters is walked once, not once per letter
    end = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < m.start():
            end = m.end()
            yield start, end


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        # a part of more than three digits, leading zeros aside, is beyond 255
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m.group())) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        # the pattern may run on into capital words behind: the longest prefix that passes
        code = m.group()
        for stop in range(len(code), 14, -1):
            if code[stop - 1] != " " and 15 <= len(plain := code[:stop].replace(" ", "")) <= 34 and mod97(plain):
                if stop == len(code) or code[stop] == " ":
                    yield m.start(), m.start() + stop
                break


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


_FINDERS = [_emails, _ips, _cards, _phones, _ibans, _ssns]


def _context(text: str, start: int, stop: int, kind: str) -> float:
    near = set(_WORD.findall(f"{text[max(0, start - WINDOW) : start]} {text[stop : stop + WINDOW]}".lower()))
    return 0.3 * bool(near.intersection(FOR[kind])) - 0.2 * bool(near.intersection(AGAINST))


def find_spans(text: str) -> list[Span]:
    """All spans of a text by start, then kind.

    Base kinds are kept at any score; others need ``LEAST_SCORE`` and must not overlap a base span.
    """
    base = []
    for rank, finder in enumerate(_FINDERS[:BASE]):
        for start, stop in finder(text):
            score = START[KINDS[rank]] + _context(text, start, stop, KINDS[rank])
            base.append(Span(start, rank, stop, round(min(1.0, max(0.0, score)), 2)))
    base.sort()
    starts, reach, furthest = [s.start for s in base], [], 0
    for s in base:
        furthest = max(furthest, s.stop)
        reach.append(furthest)
    more = []
    for rank, finder in enumerate(_FINDERS[BASE:], BASE):
        for start, stop in finder(text):
            score = START[KINDS[rank]] + _context(text, start, stop, KINDS[rank])
            begun = bisect_left(starts, stop)
            if score >= LEAST_SCORE and not (begun and bisect_right(reach, start, 0, begun) < begun):
                more.append(Span(start, rank, stop, round(min(1.0, score), 2)))
    return sorted(base + more) if more else base


SPANS = "array<struct<start:bigint,rank:int,stop:bigint,kind:string,score:double>>"


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): one row per input row, spans by start, then kind as listed; a span is (start, rank, stop, kind, score).

    The base kinds are spans at any score, so that whoever asks may set a bound; the others are spans from ``LEAST_SCORE`` on.

    A NULL text is empty and has none; repeated rows and NULL ids are rows like any other; an empty table gives
    no rows.  Every row is judged where it is read, nothing is shuffled.
    """

    def start():
        return lambda rows: [(i, [(s.start, s.rank, s.stop, s.kind, s.score) for s in find_spans(t)]) for i, t in rows]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(texts(docs, id_col, text_col), [("doc_id", kind), ("spans", SPANS)], start)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are one, named after the first."""
    parts, at = [], 0
    for s in spans:
        if s.start >= at:
            parts += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.stop)
    return "".join(parts) + text[at:]


def redact_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): the redacted texts, one row per input row; a NULL text becomes the empty one."""
    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        texts(docs, id_col, text_col), [("doc_id", kind), ("text", "string")],
        lambda: lambda rows: [(i, redact(t, find_spans(t))) for i, t in rows],
    )
