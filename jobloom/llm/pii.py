"""Personal data: generators of high recall propose spans, boosted trees score them, calibrated thresholds choose.

Four base kinds are found by fixed rules and always stay. Beside them the generators propose, in all places where the form
could be meant, account numbers, national numbers, telephone numbers without a country code, written-out mail addresses, two
kinds of device addresses, and secrets: long values that something is set to, and forms that services give their keys; proposals
may overlap. Features of the form (digits, groups, check sums) and of the words
around it go to gradient-boosted trees, learnt from labelled lines that ``labelled_lines`` writes by rule. A third of the
lines, kept out of the fit, sets each kind's threshold. Among chosen spans that overlap, the likeliest stays.
"""

from __future__ import annotations

import bisect
import random
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.llm.boosting import Trees, fit
from jobloom.llm.common import give_back, modest_batches

BASE = ("email", "ip", "card", "phone")
ADDED = ("account", "national", "local_phone", "written_email", "ipv6", "mac", "secret")
KINDS = BASE + ADDED
PRECISION = 0.98
SPAN = "array<struct<kind:string,start:int,stop:int,score:double>>"

_local = re.compile(r"[A-Za-z0-9._%+-]")
_domain = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A digit run that cannot start a match cannot start one further in, so runs are entered at their start only.
_ip = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_card = re.compile(r"[0-9]([\x20-]?[0-9])+")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_digit = re.compile(r"[0-9]")
_GENERATORS = {
    "account": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "national": re.compile(r"(?<![0-9-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9]|-[0-9])"),
    "local_phone": re.compile(r"(?<![0-9+.,)(-])\(?[0-9]{2,5}\)?(?:[\x20./-]{1,2}[0-9]{2,8}){1,4}(?![0-9]|[.,-][0-9])"),
    "ipv6": re.compile(
        r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}"
        r"|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![0-9A-Za-z:])"
    ),
    "mac": re.compile(r"(?<![0-9A-Za-z:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![0-9A-Za-z:-])"),
}
_WRITTEN = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?"
    r"[A-Za-z0-9-]{1,63}+(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}+){1,4}"
)
# The value of an assignment, without its quotes, and keys that tell themselves by their form.
_ASSIGNED = re.compile(r"""["']?[\x20\t]{0,2}(?:=>|:=|[:=])[\x20\t]{0,2}["']?([A-Za-z0-9+/_~.-]{12,}+={0,2})""")
_ISSUED = re.compile(
    r"(?<![A-Za-z0-9_-])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[a-z]_[A-Za-z0-9]{36,}+|xox[a-z]-[A-Za-z0-9-]{10,}+"
    r"|eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{4,}+)(?![A-Za-z0-9_-])"
)
_TELEPHONE = re.compile(
    r"\([0-9]{3}\)[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}|([0-9]{3})([.\x20-])[0-9]{3}\2[0-9]{4}"
    r"|0[0-9]{2,4}[\x20/-](?:[0-9]{3}[\x20-]?[0-9]{2,5}|[0-9]{6,8})|0[0-9](?:[\x20.][0-9]{2}){4}"
    r"|0[0-9]{1,4}[\x20/-][0-9]{3,4}(?:[\x20-][0-9]{2,4}){2}"
)
# Words that tell what a number before or after them is.
CUES = {
    "person": ("call", "phone", "tel", "telephone", "mobile", "cell", "fax", "telefon", "handy", "rufen", "appelez", "tél",
               "téléphone", "portable", "llame", "teléfono", "móvil", "contact", "reach", "whatsapp"),
    "identity": ("ssn", "social", "security", "passport", "national", "identity", "id", "ausweis", "identité", "identidad",
                 "dni", "insurance", "taxpayer"),
    "account": ("iban", "account", "bank", "konto", "compte", "cuenta", "transfer", "bic"),
    "secret": ("token", "secret", "password", "passwd", "pwd", "passphrase", "key", "apikey", "api_key", "access_key", "secret_key",
               "private_key", "auth", "auth_token", "access_token", "credential", "credentials", "bearer", "signature"),
    "digest": ("checksum", "sha", "sha1", "sha256", "md5", "commit", "hash", "digest", "uuid", "etag", "revision", "build", "file", "path", "url"),
    "device": ("mac", "device", "address", "host", "ipv6", "adapter", "router", "client"),
    "other": ("order", "isbn", "version", "invoice", "ref", "no", "nr", "page", "pages", "price", "total", "date", "section",
              "chapter", "score", "serial", "part", "model", "model", "room", "year", "years", "time", "at"),
}


class Span(NamedTuple):
    kind: str
    start: int
    stop: int
    score: float


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_rest(text: str) -> int:
    """Rest modulo 97 of an account number, 1 if it is sound."""
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def sound_ipv6(text: str) -> bool:
    """Eight groups, or fewer around one '::', which is not all there is."""
    groups = [g for g in text.split(":") if g]
    return len(groups) == 8 if "::" not in text else text.count("::") == 1 and 1 <= len(groups) <= 7


def telephone_form(text: str) -> bool:
    """Ten or eleven digits in the groups of a telephone number; a date, a book number or loose numbers are not."""
    return bool(_TELEPHONE.fullmatch(text))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed rules, by start, then kind; each kind leftmost and without overlap, in linear time."""
    found = []
    if "@" in text:
        end, at = 0, text.find("@")
        while at >= 0:
            start = at
            while start > end and _local.match(text[start - 1]):
                start -= 1
            match = _domain.match(text, at + 1) if start < at else None
            if match:
                end = match.end()
                found.append(Span("email", start, end, 1.0))
            at = text.find("@", max(at + 1, end))
    if _digit.search(text):
        for match in _ip.finditer(text):
            if all(int(part[-4:]) <= 255 and len(part.lstrip("0")) <= 3 for part in match.group().split(".")):
                found.append(Span("ip", *match.span(), 1.0))
        for match in _card.finditer(text):
            number = digits(match.group())
            if 12 <= len(number) <= 19 and luhn(number):
                found.append(Span("card", *match.span(), 1.0))
        for match in _phone.finditer(text):
            if 9 <= len(digits(match.group())) <= 15:
                found.append(Span("phone", *match.span(), 1.0))
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def proposals(text: str) -> list[Span]:
    """Every place where an added kind might stand."""
    found = []
    if _digit.search(text):
        found = [Span(kind, *m.span(), 0.0) for kind, g in _GENERATORS.items() for m in g.finditer(text)]
        found = [s for s in found if s.kind != "local_phone" or 7 <= len(digits(text[s.start : s.stop])) <= 12]
    if "=" in text or ":" in text:
        found += [Span("secret", *m.span(1), 0.0) for m in _ASSIGNED.finditer(text)]
    found += [Span("secret", *m.span(), 0.0) for m in _ISSUED.finditer(text)]
    if "dot" in text and ("at)" in text or "at]" in text or " at " in text):
        found += [Span("written_email", *m.span(), 0.0) for m in _WRITTEN.finditer(text)]
    return found


def features(text: str, span: Span) -> list[float]:
    """What the trees see: the kind, the form, and cue words near by."""
    inside = text[span.start : span.stop]
    number = digits(inside)
    groups = re.findall("[0-9]+", inside)
    sizes = [len(g) for g in groups] or [0]
    before = re.findall(r"\w+", text[max(0, span.start - 80) : span.start].lower())
    after = re.findall(r"\w+", text[span.stop : span.stop + 50].lower())
    near = [len(set(before[-8:]) & set(words)) + 0.5 * len(set(after[:4]) & set(words)) for words in CUES.values()]
    last = before[-1] if before else ""
    closest = [float(last in words) for words in CUES.values()]
    counts = np.unique(list(inside), return_counts=True)[1] / len(inside)
    entropy = float(-(counts * np.log2(counts)).sum())
    signs = [sum(test(c) for c in inside) / len(inside) for test in (str.isupper, str.islower, str.isdigit)]
    return [
        float(KINDS.index(span.kind)), len(inside), len(number), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        len(set(number)), float("(" in inside), inside.count("-"), inside.count("."), inside.count(" "), inside.count("/"),
        float(span.kind == "account" and iban_rest(inside) == 1), float(len(number) in (10, 11)),
        float(1900 <= int(groups[0]) <= 2100 if groups and len(groups[0]) == 4 else 0),
        float(1900 <= int(groups[-1]) <= 2100 if groups and len(groups[-1]) == 4 else 0),
        float(number[:3] in ("000", "666") or number[:1] == "9"), float(number[:1] == "0"), sum(c in "abcdefABCDEF" for c in inside),
        float(span.kind == "ipv6" and sound_ipv6(inside)), float(span.kind == "local_phone" and telephone_form(inside)), *near, *closest,
        entropy, *signs, float(span.kind == "secret" and _ISSUED.fullmatch(inside) is not None),
    ]


def labelled_lines(seed: int = 11, each: int = 60) -> list[tuple[str, Span, int]]:
    """Lines with one proposal each and whether it is personal data, written by rule from forms and cue words."""
    r = random.Random(seed)

    def number(n: int) -> str:
        return "".join(r.choice("0123456789") for _ in range(n))

    def sound_iban() -> str:
        body = r.choice(["DE", "FR", "ES", "GB"]) + "00" + number(18)
        return body[:2] + f"{98 - iban_rest(body):02d}" + body[4:]

    def grouped(plain: str) -> str:
        return " ".join(plain[i : i + 4] for i in range(0, len(plain), 4)) if r.random() < 0.5 else plain

    def date() -> str:
        y, m, d = r.randint(1950, 2030), r.randint(1, 12), r.randint(1, 28)
        return r.choice([f"{y}-{m:02d}-{d:02d}", f"{d:02d}.{m:02d}.{y}", f"{d:02d}/{m:02d}/{y}"])

    def local() -> str:
        a, b, c = number(3), number(3), number(4)
        return r.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0{a} {b} {c}", f"0{a}/{b}{number(2)}", f"0{a} {b}{c}",
                         f"0{number(1)} {number(2)} {number(2)} {number(2)} {number(2)}", f"0{number(2)} {number(3)} {number(2)} {number(2)}"])

    def loose() -> str:
        """Numbers side by side that are no telephone number."""
        while telephone_form(text := " ".join(number(r.randint(2, 5)) for _ in range(3))):
            pass
        return text

    def short() -> str:
        head = r.choice(["fe80", "2001:db8", hexa(4), f"{hexa(4)}:{hexa(3)}"])
        return r.choice([f"{head}::{hexa(r.randint(1, 4))}", f"{head}::{hexa(4)}:{hexa(3)}:{hexa(4)}", f"{head}::", f"::{hexa(4)}"])

    hexa = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    mixed = lambda n, more="": "".join(r.choice(signs + more) for _ in range(n))
    secret = lambda: r.choice([hexa(r.choice([32, 40, 64])), mixed(r.randint(16, 48)), mixed(r.randint(20, 44), "+/_-") + r.choice(["", "=", "=="])])
    issued = lambda: r.choice(["AKIA" + mixed(16).upper(), "ghp_" + mixed(36), f"eyJ{mixed(20)}.{mixed(30)}.{mixed(20)}"])
    wordy = lambda: r.choice("-_./").join(r.choice("north river stone maple report chapter general index".split()) for _ in range(3))
    name = lambda: r.choice("anna ben carla dmitri eva farid".split()) + r.choice([".", "_", ""]) + r.choice("lee moss roy sato".split())
    bracket = lambda w: r.choice([f" ({w}) ", f"[{w}]", f" [{w}] ", f"({w})"])
    plain = [w for words in ("the of and to in with that", "der die und das mit", "le la et que pour", "el los que con para") for w in words.split()]
    forms = [  # kind, form, cues that make it personal, cues that do not
        ("account", lambda: grouped(sound_iban()), ["account", "identity", None], []),
        ("account", lambda: grouped("DE" + number(20)), [], ["other", "account", None]),
        ("national", lambda: f"{r.randint(100, 665)}-{number(2)}-{number(4)}", ["identity", None], ["other"]),
        ("national", lambda: f"{r.choice(['000', '666', '9' + number(2)])}-{number(2)}-{number(4)}", [], ["identity", "other", None]),
        ("local_phone", local, ["person", None], ["other"]),
        ("local_phone", date, [], ["other", "person", None]),
        ("local_phone", loose, [], ["other", None, None]),
        ("local_phone", lambda: f"978-{number(1)}-{number(2)}-{number(5)}", [], ["other", None]),
        ("written_email", lambda: f"{name()}{bracket('at')}mail{number(1)}{bracket('dot')}com", ["person", None, "other"], []),
        ("written_email", lambda: f"{name()} at mail{number(1)} dot com", ["person", None], []),
        ("ipv6", lambda: ":".join(hexa(4) for _ in range(8)), ["device", None], []),
        ("ipv6", short, ["device", None], []),
        ("ipv6", lambda: ":".join(number(2) for _ in range(r.randint(4, 5))), [], ["other", None]),
        ("ipv6", lambda: "::", [], ["other", None]),
        ("mac", lambda: r.choice(":-").join(hexa(2) for _ in range(6)), ["device", None], []),
        ("mac", lambda: "-".join(number(2) for _ in range(6)), [], ["other", None]),
        ("secret", secret, ["secret", "secret"], ["digest", "other"]),
        ("secret", lambda: hexa(r.choice([32, 40, 64])), ["secret", "secret", "secret"], ["digest", "digest"]),
        ("secret", issued, ["secret", "other", None], []),
        ("secret", wordy, [], ["secret", "digest", "other", None]),
        ("secret", lambda: number(r.randint(12, 16)), [], ["other", None]),
    ]
    lines = []
    for kind, form, yes, no in forms:
        for label, cues in ((1, yes), (0, no)):
            for cue in cues:
                for _ in range(each if cue else each // 2):
                    words = [r.choice(plain) for _ in range(4)] + ([r.choice(CUES[cue])] if cue else [])
                    mark = ""
                    if kind == "secret":  # the value of an assignment
                        mark = r.choice(['"', "'", "", ""])
                        head = " ".join(words) + r.choice([" = ", "=", ": ", " := ", " => "]) + mark
                    else:
                        words += [r.choice(plain)] * (r.random() < 0.3)
                        head = " ".join(words) + r.choice([" ", ": ", " "])
                    inside = form()
                    text = head + inside + mark + r.choice([" ", ". ", ", "] if mark or kind != "secret" else [" ", "\n", ", "]) + r.choice(plain)
                    lines.append((text, Span(kind, len(head), len(head) + len(inside), 0.0), label))
    r.shuffle(lines)
    return lines


class Model(NamedTuple):
    trees: Trees
    thresholds: dict[str, float]


@lru_cache(maxsize=1)
def trained() -> Model:
    """Trees, and for each kind the lowest score at which nearly all held-out lines above are personal."""
    lines = labelled_lines()
    x = np.array([features(text, span) for text, span, _ in lines])
    y = np.array([label for _, _, label in lines], float)
    kept = np.arange(len(lines)) % 3 == 0
    trees = fit(x[~kept], y[~kept])
    p = trees.probability(x)
    thresholds = {}
    for kind in ADDED:
        own = kept & (x[:, 0] == KINDS.index(kind))
        steps = np.unique(np.floor(p[own] * 1000) / 1000)
        sound = [s for s in steps if s >= 0.5 and y[own][p[own] >= s].mean() >= PRECISION]
        thresholds[kind] = float(min(sound, default=1.1))
    return Model(trees, thresholds)


def find(text: str, model: Model) -> list[Span]:
    """Base spans, and the proposals that are likely enough; of added spans that overlap anything, the likeliest stays."""
    base = base_spans(text)
    offered = proposals(text)
    if not offered:
        return base
    scores = model.trees.probability(np.array([features(text, s) for s in offered]))
    chosen = [s._replace(score=float(p)) for s, p in zip(offered, scores, strict=True) if p >= model.thresholds[s.kind]]
    kept: list[Span] = []
    starts = [s.start for s in base]
    stops = list(accumulate((s.stop for s in base), max))  # the furthest that any span up to here reaches
    free = [s for s in chosen if not _meets(starts, stops, s)]
    last: list[Span] = []
    for s in sorted(free, key=lambda s: (s.start, -s.score)):  # groups of overlapping spans, one after another
        if last and s.start >= max(t.stop for t in last):
            kept += _likeliest(last)
            last = []
        last.append(s)
    kept += _likeliest(last)
    return sorted(base + kept, key=lambda s: (s.start, KINDS.index(s.kind)))


def _meets(starts: list[int], stops: list[int], span: Span) -> bool:
    """Whether one of the spans that begin before the end of ``span`` reaches beyond its start."""
    k = bisect.bisect_left(starts, span.stop)
    return k > 0 and stops[k - 1] > span.start


def _likeliest(group: list[Span]) -> list[Span]:
    kept: list[Span] = []
    for s in sorted(group, key=lambda s: (-s.score, s.start, KINDS.index(s.kind))):
        if all(s.stop <= t.start or t.stop <= s.start for t in kept):
            kept.append(s)
    return kept


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: kind, start, stop (code points, stop exclusive) and score, by start, then kind.

    A null or empty text has no spans. Whole texts are searched; repeated rows each get theirs; other columns stay, whatever their
    names, but for a column ``spans``, which is replaced. An empty table gives an empty result.
    """
    modest_batches(docs.sparkSession)
    model = trained()
    rows = docs.drop("spans")
    schema = rows.withColumn("spans", F.lit(None).cast(SPAN)).schema

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [find(t, model) if isinstance(t, str) else [] for t in frame[text]]
            yield frame.assign(spans=[[s._asdict() for s in spans] for spans in found])
        give_back()

    return rows.mapInPandas(run, schema)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` of ``detect`` with every span of the text replaced by its kind in capitals and brackets; nulls stay null."""
    marked = F.transform("spans", lambda s: F.struct(s["start"].alias("a"), s["stop"].alias("b"), s["kind"].alias("k")))
    step = lambda acc, s: F.struct(  # noqa: E731  overlapping base spans are replaced together
        F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, F.greatest(s["a"] - acc["at"], F.lit(0))),
            F.when(s["a"] >= acc["at"], F.concat(F.lit("["), F.upper(s["k"]), F.lit("]"))).otherwise(""),
        ).alias("out"),
        F.greatest(acc["at"], s["b"]).alias("at"),
    )
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate(marked, start, step)
    whole = F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    return docs.withColumn(text, F.when(F.size("spans") > 0, whole).otherwise(F.col(text)))


def listed(spans: Column) -> Column:
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(each, ",")


def detect_documents(documents: DataFrame) -> DataFrame:
    """Result of the query: counts and digest of the base spans, and all spans."""
    found = detect(documents.select("doc_id", "text")).select("doc_id", "spans")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *[count(kind) for kind in BASE], F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"),
    )
