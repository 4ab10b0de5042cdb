"""Personal data: fixed patterns, and a trained tagger for ways of writing that they miss.

The patterns find e-mail addresses, IP addresses, card numbers and phone numbers in their
plain forms. A conditional random field over word shapes, trained from a small labelled
table, reads every line that can hold one of the four kinds (see ``_CUE``) and tags them in
other forms: ``name (at) host (dot) org``, ``name at host dot org``, ``10[.]0[.]0[.]7``, ``4111.1111.1111.1111``,
``(512) 555-0100``. What it tags counts if it passes the same checks of digits as the
plain form, and if no pattern has claimed a part of it; it is reported under the kinds
``crf_email``, ``crf_ip``, ``crf_card`` and ``crf_phone``, so pattern spans and tagged spans never
mix.

Defined results: a null or empty text has no spans; places count code points and ends are
exclusive; a number that is two kinds at once is reported as both; repeated rows get equal
results; an empty table gives an empty result, and without labelled lines the tagger finds
nothing. Columns beside the ones named are ignored, and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tributary.llm.crf import KINDS, LABELS, Tagger, tokens, train
from tributary.llm.tables import batches, each_row, pick, place

Span = tuple[str, int, int]

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)++")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Every value that ``_valid`` accepts holds one of these, so no line without them is tagged: a
#: digit, an at sign, an at in brackets, or the word at before a host and some form of dot.
_CUE = re.compile(
    r"[0-9@]|[(\[]at[)\]]"
    r"|[^\S\n]at[^\S\n]++[a-z0-9-]++(?:\.|[^\S\n]*+[(\[](?:dot|\.)[)\]]|[^\S\n]++dot[^\S\n])",
    re.IGNORECASE,
)


def _emails(text: str) -> Iterator[Span]:
    floor = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            floor = host.end()
            yield "email", start, floor
        at = text.find("@", max(at + 1, floor))


def _ips(text: str) -> Iterator[Span]:
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        at = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(is_byte(part) for part in four):
                yield "ip", at, end
            at = end + 1


def is_byte(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def is_card(text: str) -> bool:
    digits = [int(c) for c in text if "0" <= c <= "9"]
    if not 14 <= len(digits) <= 19:
        return False
    twice = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
    return sum(twice) % 10 == 0


def is_phone(text: str) -> bool:
    return 10 <= sum("0" <= c <= "9" for c in text) <= 15


def base_spans(text: str) -> list[Span]:
    """What the fixed patterns find, by start and then in the order of kinds."""
    found: list[Span] = []
    if "@" in text:
        found += _emails(text)
    found += _ips(text)
    found += (("card", *m.span()) for m in _DIGITS.finditer(text) if is_card(m.group()))
    if "+" in text:
        found += (("phone", *m.span()) for m in _PHONE.finditer(text) if is_phone(m.group()))
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))


def _lines(text: str) -> Iterator[tuple[int, str]]:
    """Lines that can hold personal data, with their places."""
    at = 0
    while cue := _CUE.search(text, at):
        start = text.rfind("\n", 0, cue.start()) + 1
        end = text.find("\n", cue.start())
        end = len(text) if end < 0 else end
        yield start, text[start:end]
        at = end


_AT = re.compile(r"\s*[(\[]at[)\]]\s*|\s+at\s+", re.IGNORECASE)
_DOT = re.compile(r"\s*[(\[](?:dot|\.)[)\]]\s*|\s+dot\s+", re.IGNORECASE)
_FORMS = {
    "ip": re.compile(r"[0-9]+(?: ?[\[(]?\.[\])]? ?[0-9]+){3}"),
    "card": re.compile(r"[0-9](?:[ ./-]{0,3}[0-9])+"),
    "phone": re.compile(r"\+?\(?[0-9](?:[ ()./-]{0,3}[0-9])+"),
}


def _valid(kind: str, value: str) -> bool:
    """The checks of the plain form, on the form that was tagged."""
    if kind == "email":
        plain = _AT.sub("@", value)
        plain = _DOT.sub(".", plain)
        return any(a == 0 and b == len(plain) for _, a, b in _emails(plain))
    if not _FORMS[kind].fullmatch(value):
        return False
    if kind == "ip":
        return all(map(is_byte, re.findall(r"[0-9]+", value)))
    return is_card(value) if kind == "card" else is_phone(value)


def tagged_spans(texts: list[str], tagger: Tagger) -> list[list[Span]]:
    """What the tagger finds in each text, before it is held against the patterns."""
    where: list[tuple[int, int, str, list[tuple[int, int, str]]]] = []
    for i, text in enumerate(texts):
        where += ((i, at, line, tokens(line)) for at, line in _lines(text))
    paths = tagger.decode([[word for _, _, word in words] for *_, words in where])
    out: list[list[Span]] = [[] for _ in texts]
    for (i, at, line, words), path in zip(where, paths, strict=True):
        if not path.any():
            continue
        t = 0
        while t < len(path):
            if path[t] == 0:
                t += 1
                continue
            kind = LABELS[path[t]][2:]
            last = t
            while last + 1 < len(path) and LABELS[path[last + 1]] == f"I-{kind}":
                last += 1
            start, end = words[t][0], words[last][1]
            value = line[start:end]
            left = len(value) - len(value.lstrip(".,;:!?\"'<>[{*#$%&|"))
            right = len(value) - len(value.rstrip(".,;:!?\"'<>]}*#$%&|"))
            start, end = start + left, end - right
            if start < end and _valid(kind, line[start:end]):
                out[i].append((f"crf_{kind}", at + start, at + end))
            t = last + 1
    return out


def all_spans(texts: list[str], tagger: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """(spans of the patterns, all spans) of each text."""
    out = []
    order = {name: i for i, name in enumerate([*KINDS, *(f"crf_{kind}" for kind in KINDS)])}
    for text, more in zip(texts, tagged_spans(texts, tagger), strict=True):
        base = base_spans(text)
        new = [s for s in more if not any(s[1] < b and s[2] > a for _, a, b in base)]
        out.append((base, sorted(base + new, key=lambda s: (s[1], order[s[0]]))))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


#: Labelled lines from which the tagger is trained, at most.
TABLE_ROWS = 2000


def labelled_lines(rows: int = 500, seed: int = 42) -> list[tuple[str, list[Span]]]:
    """A small labelled table, made by rule: invented words around personal data and around
    look-alikes such as dates, versions, prices and keys."""
    rng = Random(seed)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def word(vowels: str = "aeiouéü") -> str:
        made = "".join(rng.choice("bcdfglmnprst") + rng.choice(vowels) for _ in range(rng.randint(1, 4)))
        return (made.capitalize() if rng.random() < 0.1 else made) + rng.choice(["", "", "", "", ",", "."])

    def card() -> str:
        digits = "4" + number(14)
        return next(digits + d for d in "0123456789" if is_card(digits + d))

    def plain() -> str:
        return word("aeiou").strip(",.").lower()

    def name() -> str:
        return plain() + rng.choice(["", number(2), f".{plain()}", f"_{plain()}", f".{number(2)}"])

    def email() -> str:
        user, host, top = name(), plain(), rng.choice(["com", "org", "net"])
        return rng.choice(
            [f"{user}@{host}.{top}", f"{user} (at) {host} (dot) {top}", f"{user}[at]{host}.{top}",
             f"{user} at {host} dot {top}", f"{user} [at] {host} [dot] {top}"]
        )

    def ip() -> str:
        return rng.choice([".", "[.]", " . ", "(.)"]).join(str(rng.randint(0, 255)) for _ in range(4))

    def spaced_card() -> str:
        digits = card()
        return rng.choice(["", "", "", " ", "-", ".", "/"]).join(digits[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        a, b, c = number(3), number(3), number(4)
        return rng.choice(
            [f"+1 ({a}) {b}-{c}", f"+49 {a} {b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}",
             f"{a}.{b}.{c}", f"+1 ({a}) {b}-{c}"]
        )

    def other() -> str:
        return rng.choice(
            [str(rng.randint(1900, 2030)), f"{number(2)}:{number(2)}", f"{number(1)}.{number(2)}",
             f"{number(1)},{number(3)}.{number(2)}", f"v{number(1)}.{number(2)}.{number(1)}",
             f"20{number(2)}-{number(2)}-{number(2)}", number(8), f"#{number(4)}",
             f'token = "{rng.getrandbits(160):x}"', f"password={rng.getrandbits(72):x}", f"{number(3)}-{number(1)}-{number(2)}-{number(6)}-{number(1)}",
             f"@{word().strip(',.')}", f"{number(1)}x{number(1)}", number(10), f"{number(5)}$$$",
             f"{number(3)}-{number(4)}", f"{number(2)}.{number(2)}.20{number(2)}", f"({number(4)})",
             f"{number(2)} %", f"{number(3)} {number(3)}", f"key_{number(6)}", number(20)]
        )

    cues = {"email": "email:", "ip": "host", "card": "card", "phone": "tel:"}
    makers = {"email": email, "ip": ip, "card": spaced_card, "phone": phone}
    table = []
    for _ in range(rows):
        line, spans = "", []
        for _ in range(rng.randint(1, 3)):
            line += "".join(word() + " " for _ in range(rng.choice([0, 0, 1, 3, 5])))
            if rng.random() < 0.5:
                line += other() + " "
                continue
            kind = rng.choice(KINDS)
            if rng.random() < 0.3:
                line += cues[kind] + " "
            value = makers[kind]()
            spans.append((kind, len(line), len(line) + len(value)))
            line += value + rng.choice(["", "", ".", ","]) + " "
        line += "".join(" " + word() for _ in range(rng.randint(0, 4)))
        table.append((line, spans))
    return table


_TABLE = "text string, spans array<struct<kind: string, start: int, end: int>>"


def labelled_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_lines(), _TABLE)


def fit_tagger(labelled: DataFrame, table_rows: int = TABLE_ROWS) -> Tagger:
    """The tagger from a small labelled table (text, spans); it must not be larger than stated."""
    rows = labelled.select("text", "spans").limit(table_rows + 1).collect()
    if len(rows) > table_rows:
        raise ValueError(f"the labelled table has more than {table_rows} rows")
    lines = [(r.text or "", [tuple(s) for s in r.spans or []]) for r in rows]
    return train(sorted(lines))


def find_personal(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """Per document: spans of each pattern, a digest of them, and all spans."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [x.as_py() or "" for x in part.column("text")]
        found = all_spans(texts, tagger)
        counts = np.array(
            [[sum(s[0] == kind for s in base) for kind in KINDS] for base, _ in found], np.int64
        ).reshape(-1, len(KINDS))
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                *map(pa.array, counts.T),
                pa.array([joined(base) for base, _ in found], pa.string()),
                pa.array([joined(spans) for _, spans in found], pa.string()),
            ],
            ["doc_id", *(f"n_{kind}" for kind in KINDS), "base", "spans"],
        )

    return batches(
        pick(docs, doc_id="bigint", text="string"),
        work,
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base string, spans string",
    )


def hidden(text: str, spans: list[Span]) -> str:
    """The text with ``<kind>`` in place of each span; spans that overlap become one."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.removeprefix('crf_')}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """The documents with personal data replaced; ``n_chars`` follows where there is one."""
    names = docs.columns
    text_at = int(place(docs, "text")[1:])
    counted = "n_chars" in [name.lower() for name in names]
    chars_at = int(place(docs, "n_chars")[1:]) if counted else -1

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        old = part.column(text_at)
        texts = [x.as_py() for x in old]
        found = all_spans([text or "" for text in texts], tagger)
        new = [
            hidden(text, spans) if spans else text
            for text, (_, spans) in zip(texts, found, strict=True)
        ]
        columns = list(part.columns)
        columns[text_at] = pa.array(new, old.type)
        if counted:
            at = chars_at
            counts = [
                len(text) if spans else n.as_py()
                for text, (_, spans), n in zip(new, found, columns[at], strict=True)
            ]
            columns[at] = pa.array(counts, columns[at].type)
        return pa.RecordBatch.from_arrays(columns, names)

    return each_row(docs, work)
