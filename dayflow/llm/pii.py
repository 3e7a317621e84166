"""Personal data: fixed patterns plus candidates scored by gradient boosting.

Fixed patterns find base spans of four kinds (``email``, ``ip``, ``card``, ``phone``);
they always stay.  Generators of high recall propose further, overlapping spans:
every plausible run of digit groups (as phone, card or social security number),
written-out addresses (``name (at) host dot org``), defanged ips (``10[.]0[.]0[.]1``)
and account numbers.  Boosted trees, one set a kind, score a candidate by format
(groups, separators, check digits) and context (neighbouring characters, cue words,
digits nearby).  A threshold a kind, calibrated on held-out candidates for a wanted
precision, selects; of overlapping candidates the surest stays, and none that
overlaps a base span is added.

There are no labels for personal data, so the fit makes its own from a bounded sample
of documents (``FIT_DOCS``, by hash order): the base spans found in them, and written
variants planted at random places, are right; every other candidate of the same
texts, look-alikes planted beside them included (dates, versions, order numbers,
numbers that fail their check digits), is wrong.

Offsets are code points, ends exclusive.  Texts are scanned whole, in time linear in
their length.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayflow.llm.common import stretches

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("email_like", "ip_like", "card_like", "phone_like", "iban", "ssn")
KINDS = BASE_KINDS + ADDED_KINDS
EMAIL, IP, CARD, PHONE, IBAN, SSN = range(6)    # of base spans and of candidates

FIT_DOCS = 4_000            # documents that the fit reads
FIT_CANDIDATES = 40_000     # candidates of them that reach the driver
PLANTED = 16_000            # cases planted in them, all documents together
PRECISION = 0.98            # wanted of the candidates above a threshold
TREES, DEPTH, RATE, BINS, MIN_LEAF = 60, 3, 0.2, 32, 8

# The four base patterns.  A run that fails from its start fails from any
# place inside it, so looking back one character or from the ``@`` finds the same matches.
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
QUAD = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
DIGIT_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PLUS_RUN = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGITS = re.compile(r"[0-9]+")
GAP = re.compile(r"[ .-]?|\) ?|-?\(|\)[.-]")
AT = re.compile(r" ?[\[({<] ?(?:at|AT|@) ?[\])}>] ?| (?:at|AT|@) ", re.ASCII)
HOST = re.compile(r"[A-Za-z0-9-]{1,63}+(?:(?:\.| ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?| (?:dot|DOT) )"
                  r"[A-Za-z][A-Za-z0-9-]{0,62}+)++")
DEFANGED = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)| ?[\[(]dot[\])] ?)[0-9]{1,3}){3}(?![0-9])")
ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
                     r"(?![A-Za-z0-9])")
CUES = tuple(re.compile(p, re.IGNORECASE) for p in (
    r"\b(?:e-?mails?|mail|contact|write|kontakt|correo|courriel|contacto)\b",
    r"\b(?:ip|host|server|address|adresse|servidor|serveur)\b",
    r"\b(?:card|visa|mastercard|amex|credit|debit|karte|kreditkarte|carte|tarjeta)\b",
    r"\b(?:tel|phone|telephone|call|mobile|cell|fax|whatsapp|telefon|anruf|handy|appel|"
    r"téléphone|teléfono|llama|móvil)\b",
    r"\b(?:iban|account|bank|konto|compte|cuenta)\b",
    r"\b(?:ssn|social security)\b",
    r"\b(?:order|invoice|version|page|ref|isbn|no|nr|build|ticket|rechnung|commande|pedido|"
    r"total|seite|date)\b|[#$€£]"))
NEAR = 40                   # characters of context on either side


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += (2 * d - 9 * (d > 4)) if i % 2 else d
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Check digits of an account number without blanks."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def only_digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, by start and then kind."""
    out = []
    last = 0
    for m in DOMAIN.finditer(text) if "@" in text else ():
        at = m.start()
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            out.append((start, EMAIL, m.end()))
            last = m.end()
    for m in QUAD.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append((m.start(), IP, m.end()))
    for m in DIGIT_RUN.finditer(text):
        if m.end() - m.start() <= 37 and 12 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), CARD, m.end()))
    for m in PLUS_RUN.finditer(text) if "+" in text else ():
        if 9 <= sum(map(len, DIGITS.findall(m[0]))) <= 15:
            out.append((m.start(), PHONE, m.end()))
    return sorted(out)


def _group_windows(text: str) -> Iterator[tuple[int, int, int]]:
    """Runs of 1 to 6 digit groups with up to two signs between neighbours.

    Groups inside a run have two digits or more; a plus or bracket in front is taken.  A
    run that its own sign links to further groups on both sides is the middle of a list
    of numbers and is not proposed.
    """
    groups = [m.span() for m in DIGITS.finditer(text)]
    gaps: list[str | None] = [None]
    for (_, end), (start, _) in zip(groups, groups[1:]):
        gap = text[end:start] if start - end <= 2 else None
        gaps.append(gap if gap is not None and GAP.fullmatch(gap) else None)
    gaps.append(None)
    for i, (start, end) in enumerate(groups):
        n, lead = end - start, start
        while lead and start - lead < 2 and text[lead - 1] in "+(":
            lead -= 1
        j = i
        while n <= 19:
            if j == i or gaps[i] is None or not gaps[i] == gaps[i + 1] == gaps[j + 1]:
                if 7 <= n <= 15 and (j > i or lead < start):
                    yield lead, PHONE, groups[j][1]
                if n >= 12 and lead == start and j - i < 5:
                    yield start, CARD, groups[j][1]
                if n == 9 and j == i + 2 and [e - s for s, e in groups[i:j + 1]] == [3, 2, 4]:
                    yield start, SSN, groups[j][1]
            j += 1
            if j - i > 5 or gaps[j] is None or \
                    j - i > 1 and groups[j - 1][1] - groups[j - 1][0] < 2:
                break
            n += groups[j][1] - groups[j][0]


def candidates(text: str) -> list[tuple[int, int, int]]:
    """All proposed ``(start, kind, end)``; they may overlap each other and base spans."""
    out = []
    last = 0
    for m in AT.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start() and (host := HOST.match(text, m.end())):
            out.append((start, EMAIL, host.end()))
        last = m.end()
    out += [(m.start(), IP, m.end()) for m in DEFANGED.finditer(text)]
    out += [(m.start(), IBAN, m.end()) for m in ACCOUNT.finditer(text)]
    return out + list(_group_windows(text))


def _class(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalnum() else 2 if c in ".,;:!?)" else 3


FEATURES = (
    "chars", "digits", "groups", "shortest", "longest", "first_group", "last_group", "blanks",
    "dashes", "dots", "brackets", "one_sign", "plus", "bracket_first", "luhn", "mod97",
    "lead_digit", "distinct", "letters", "upper", "quad", "before", "after", "linked_before",
    "linked_after", "near_digits", "date_like", "at_form", "dot_form", "labels", "last_label",
    *[f"cue_{k}" for k in (*ADDED_KINDS, "other")])


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context of one candidate, in the order of ``FEATURES``."""
    span = text[start:end]
    groups = DIGITS.findall(span)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    signs = {c for c in span if c in " .-"}
    left, right = text[max(0, start - NEAR):start], text[end:end + NEAR]
    near = sum(c.isdigit() for c in left + right)
    bare = span.replace(" ", "")
    first = int(groups[0]) if groups and len(groups[0]) < 5 else 0
    dated = (len(sizes) == 3 and sizes in ([4, 2, 2], [2, 2, 4], [4, 1, 2], [1, 2, 4])
             and (1900 <= first <= 2100 or len(groups[2]) == 4
                  and 1900 <= int(groups[2]) <= 2100))
    labels = re.split(r"\.|dot|DOT", span) if kind == EMAIL else [""]
    return [
        end - start, len(digits), len(groups), min(sizes), max(sizes), sizes[0], sizes[-1],
        span.count(" "), span.count("-"), span.count("."),
        span.count("(") + span.count("[") + span.count("{"), len(signs) <= 1,
        span[0] == "+", span[0] == "(", luhn(digits) if kind == CARD else 0,
        mod97(bare) if kind == IBAN else 0, int(digits[0]) if digits else -1, len(set(digits)),
        sum(c.isalpha() for c in span), sum(c.isupper() for c in span),
        len(sizes) == 4 and max(sizes) <= 3 and all(int(g) <= 255 for g in groups),
        _class(left[-1:]), _class(right[:1]),
        bool(re.search(r"[0-9][ ().-]{0,2}$", left)), bool(re.match(r"[ ().-]{0,2}[0-9]", right)),
        near, dated,
        2 if kind != EMAIL or re.search(r"[\[({<] ?(?:at|AT|@)", span) else "@" in span,
        2 if kind != EMAIL or re.search(r"[\[({<] ?(?:dot|DOT)", span)
        else " dot " in span.lower(),
        len(labels), len(labels[-1].strip(" )]}>")),
        *[bool(c.search(left)) for c in CUES]]


# ---- boosted trees ---------------------------------------------------------------


@dataclass(frozen=True)
class Boosted:
    """Trees as full binary tables: test ``column > cut`` at inner nodes, values at leaves."""

    columns: np.ndarray        # trees x inner nodes
    cuts: np.ndarray
    leaves: np.ndarray         # trees x 2 ** depth
    start: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for col, cut, leaf in zip(self.columns, self.cuts, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, col[node]] > cut[node])
            out += leaf[node - (len(leaf) - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray) -> Boosted:
    """Logistic boosting of depth-limited trees on binned features (second order)."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)])
    rate = (y.sum() + 1) / (len(y) + 2)
    score = np.full(len(y), np.log(rate / (1 - rate)))
    inner = 2 ** DEPTH - 1
    model = Boosted(np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf),
                    np.zeros((TREES, inner + 1)), float(score[0]) if len(y) else 0.0)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-score))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        for k in range(inner):
            rows = np.flatnonzero(node == k)
            best = (1e-6, 0, np.inf, None)
            if len(rows) >= 2 * MIN_LEAF:
                g, h = grad[rows], hess[rows]
                for c, at in enumerate(cuts):
                    b = binned[rows, c]
                    gl = np.cumsum(np.bincount(b, g, len(at) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, h, len(at) + 1))[:-1]
                    n = np.cumsum(np.bincount(b, minlength=len(at) + 1))[:-1]
                    ok = (n >= MIN_LEAF) & (len(rows) - n >= MIN_LEAF)
                    if not ok.any():
                        continue
                    gain = np.where(ok, gl ** 2 / (hl + 1) + (g.sum() - gl) ** 2
                                    / (h.sum() - hl + 1) - g.sum() ** 2 / (h.sum() + 1), -1)
                    if gain[j := int(gain.argmax())] > best[0]:
                        best = (gain[j], c, at[j], j)
            model.columns[t, k], model.cuts[t, k] = best[1], best[2]
            above = binned[rows, best[1]] > best[3] if best[3] is not None else False
            node[rows] = 2 * k + 1 + above
        leaf = node - inner
        g = np.bincount(leaf, grad, inner + 1)
        h = np.bincount(leaf, hess, inner + 1)
        model.leaves[t] = RATE * g / (h + 1)
        score += model.leaves[t][leaf]
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest score and share of right ones of each step, by rising score.

    Neighbouring steps are joined until shares rise (pool adjacent violators).
    """
    order = np.argsort(score, kind="stable")
    steps: list[list[float]] = []                       # lowest score, right, all
    for s, right in zip(score[order], y[order]):
        if steps and steps[-1][0] == s:
            steps[-1][1:] = [steps[-1][1] + right, steps[-1][2] + 1]
        else:
            steps.append([s, right, 1])
        while len(steps) > 1 and steps[-1][1] * steps[-2][2] <= steps[-2][1] * steps[-1][2]:
            _, r, n = steps.pop()
            steps[-1][1:] = [steps[-1][1] + r, steps[-1][2] + n]
    return np.array([s for s, _, _ in steps]), np.array([r / n for _, r, n in steps])


def calibrated(score: np.ndarray, y: np.ndarray, precision: float = PRECISION) -> float:
    """Score from which a held-out candidate is right with ``precision`` or more.

    The share of right ones is calibrated to rise with the score.  Fewer right ones than
    could show that precision (98 for 0.98) give none: infinite.
    """
    if y.sum() < 2 * precision / (1 - precision):
        return float("inf")
    lowest, share = isotonic(score, y)
    good = np.flatnonzero(share >= precision)
    return float(lowest[good[0]]) if len(good) else float("inf")


@dataclass(frozen=True)
class Model:
    """Boosted trees and threshold of each kind that has one."""

    trees: dict[int, Boosted]
    thresholds: dict[int, float]

    def scores(self, kinds: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Logit above the threshold; minus infinity for kinds without trees."""
        out = np.full(len(x), -np.inf)
        for k, trees in self.trees.items():
            rows = np.flatnonzero(kinds == k)
            if len(rows):
                out[rows] = trees.logit(x[rows]) - self.thresholds[k]
        return out


# ---- training texts --------------------------------------------------------------

_SAYS = {
    EMAIL: ("email", "mail", "contact", "Kontakt", "correo"), IP: ("server", "host", "ip"),
    CARD: ("card", "visa", "Karte", "tarjeta"), PHONE: ("call", "tel", "phone", "Telefon", "fax"),
    IBAN: ("iban", "account", "Konto"), SSN: ("ssn", "social security"), -1: (
        "order", "version", "page", "ref", "no.", "invoice", "date", "total", "#")}


def _number(r: random.Random, n: int) -> str:
    return str(r.randint(1, 9)) + "".join(str(r.randint(0, 9)) for _ in range(n - 1))


def _made(r: random.Random) -> tuple[int, str]:
    """A kind (-1: a look-alike) and a text of it."""
    kind = r.choice((EMAIL, IP, CARD, PHONE, PHONE, IBAN, SSN, -1, -1, -1, -1, -1))
    word = lambda: "".join(r.choice("abcdefghijklmnoprstuw") for _ in range(r.randint(2, 9)))
    if kind == EMAIL:
        at, dot = r.choice(((" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), ("(at)", "."),
                            (" at ", " dot "), (" {at} ", " {dot} ")))
        return kind, word() + r.choice(("", f".{word()}", _number(r, 2))) + at + word() + dot \
            + r.choice(("com", "org", "net", "de", "fr", "es"))
    if kind == IP:
        return kind, r.choice(("[.]", "(.)", "[dot]")).join(str(r.randint(0, 255)) for _ in range(4))
    if kind == CARD:
        body = _number(r, 15)
        body += next(str(d) for d in range(10) if luhn(body + str(d)))
        return kind, r.choice(".-  ").join(body[i:i + 4] for i in range(0, 16, 4))
    if kind == PHONE:
        area, a, b = _number(r, 3), _number(r, 3), _number(r, 4)
        pairs = " ".join(_number(r, 2) for _ in range(4))
        return kind, r.choice((f"({area}) {a}-{b}", f"{area}-{a}-{b}", f"{area}.{a}.{b}",
                               f"0{r.randint(1, 9)} {pairs}", f"1-{area}-{a}-{b}", f"({area}) {a}.{b}"))
    if kind == IBAN:
        land, rest = r.choice(("DE", "FR", "ES", "GB")), _number(r, r.choice((16, 18, 20)))
        check = 98 - int("".join(str(int(c, 36)) for c in f"{rest}{land}00")) % 97
        whole = f"{land}{check:02d}{rest}"
        return kind, whole if r.random() < 0.5 else " ".join(
            whole[i:i + 4] for i in range(0, len(whole), 4))
    if kind == SSN:
        return kind, f"{_number(r, 3)}-{_number(r, 2)}-{_number(r, 4)}"
    y, m, d = r.randint(1950, 2030), r.randint(1, 12), r.randint(1, 28)
    at, dot = r.choice(((" at ", "."), (" at ", " dot "), (" at ", ". "), (" @ ", ".")))
    if r.random() < 0.3:
        return kind, r.choice((
            f"{word()}{at}{word()}{dot}{word()}", f"{word()} at {word()}.{word().title()} {word()}",
            r.choice(("[.]", "(.)")).join(str(r.randint(200, 999)) for _ in range(4)),
            "(.)".join(str(r.randint(0, 9)) for _ in range(4))))
    return kind, r.choice((
        f"{y}-{m:02d}-{d:02d}", f"{d:02d}.{m:02d}.{y}", f"{y}-{y + r.randint(1, 9)}",
        _number(r, r.randint(4, 11)), _number(r, 16), f"{_number(r, 2)}.{_number(r, 2)}.{_number(r, 4)}",
        f"{_number(r, 1)},{_number(r, 3)}.{_number(r, 2)}", f"{_number(r, 4)}-{_number(r, 4)}",
        " ".join(_number(r, r.randint(1, 5)) for _ in range(r.randint(2, 8))),
        "-".join(_number(r, 4) for _ in range(4)), f"XK{_number(r, 18)}",
        f"{_number(r, 2)}-{_number(r, 3)}-{_number(r, 5)}-{_number(r, 1)}"))


def training_rows(text: str, seed: int, plants: int) -> list[tuple[int, int, list[float]]]:
    """``(kind, label, features)`` of every candidate of a text with planted cases."""
    r = random.Random(seed)
    right = {(s, k, e) for s, k, e in base_spans(text)}
    gaps = [m.start() for m in re.finditer(" ", text)] or [len(text)]
    out, at, pieces, shift = [], 0, [], 0
    moved: set[tuple[int, int, int]] = set()
    planted: list[tuple[int, int, int]] = []
    for gap in sorted(r.sample(gaps, min(plants, len(gaps)))):
        if any(s <= gap < e for s, _, e in right):
            continue
        kind, case = _made(r)
        say = r.choice(_SAYS[kind]) + r.choice((" ", ": ")) if r.random() < 0.6 else ""
        pieces += [text[at:gap], " ", say, case]
        start = gap + shift + 1 + len(say)
        if kind >= 0:
            planted.append((start, kind, start + len(case)))
        moved |= {(s + shift, k, e + shift) for s, k, e in right if at <= s < gap}
        shift += 1 + len(say) + len(case)
        at = gap
    moved |= {(s + shift, k, e + shift) for s, k, e in right if s >= at}
    whole = "".join([*pieces, text[at:]])
    right = moved | set(planted)
    for s, k, e in dict.fromkeys(candidates(whole)):
        out.append((k, int((s, k, e) in right), features(whole, s, k, e)))
    return out


_FIT_SCHEMA = "kind int, label int, held boolean, place bigint, x array<double>"


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", n_docs: int = FIT_DOCS,
        n_candidates: int = FIT_CANDIDATES) -> Model:
    """Trees and thresholds from a sample of ``n_docs`` documents by hash of their id.

    Their candidates are made where the texts are; at most ``n_candidates`` rows of
    numbers reach the driver.  A quarter of the documents is held out for the
    thresholds.  Null ids are not sampled; a kind without both labels gets no trees.
    """
    keyed = docs.select(F.col(id_col).cast("string").alias("id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    taken = (keyed.select("id").filter("id is not null").distinct()
             .orderBy(F.xxhash64("id"), "id").limit(n_docs))
    plants = -(-PLANTED // max(1, taken.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seed = zlib.crc32(doc.encode())
                rows = training_rows(text, seed, plants)
                if rows:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([k for k, _, _ in rows], pa.int32()),
                        pa.array([y for _, y, _ in rows], pa.int32()),
                        pa.array([seed % 4 == 0] * len(rows)),
                        pa.array([zlib.crc32(f"{doc}:{i}".encode()) for i in range(len(rows))],
                                 pa.int64()),
                        pa.array([[float(v) for v in x] for _, _, x in rows],
                                 pa.list_(pa.float64()))], ["kind", "label", "held", "place", "x"])

    rows = (keyed.join(F.broadcast(taken), "id").select("id", "text")
            .mapInArrow(run, _FIT_SCHEMA))
    # the right ones are few: both labels get half of the rows at least
    parts = [rows.filter(F.col("label") == y).orderBy("place", "x").limit(n_candidates // 2)
             for y in (0, 1)]
    got = parts[0].unionAll(parts[1]).toArrow()
    kind, label = got["kind"].to_numpy(), got["label"].to_numpy().astype(float)
    held = got["held"].to_numpy(zero_copy_only=False)
    x = np.array(got["x"].to_pylist(), float).reshape(len(kind), len(FEATURES))
    trees, thresholds = {}, {}
    for k in range(len(ADDED_KINDS)):
        learn, test = (kind == k) & ~held, (kind == k) & held
        if 0 < label[learn].sum() < learn.sum():
            model = boost(x[learn], label[learn])
            cut = calibrated(model.logit(x[test]), label[test])
            if np.isfinite(cut):
                trees[k], thresholds[k] = model, cut
    return Model(trees, thresholds)


# ---- scan ------------------------------------------------------------------------


def scan_texts(texts: list[str], model: Model) -> list[list[tuple[int, int, int]]]:
    """All spans ``(start, index in KINDS, end)`` of each text, by start and then kind."""
    found = [base_spans(t) for t in texts]
    where, spans, rows = [], [], []
    for i, text in enumerate(texts):
        covered = np.zeros(len(text), bool)
        for s, _, e in found[i]:
            covered[s:e] = True
        for s, k, e in dict.fromkeys(candidates(text)):
            if k in model.trees and not covered[s:e].any():
                where.append(i)
                spans.append((s, k, e))
                rows.append(features(text, s, k, e))
    if not rows:
        return found
    score = model.scores(np.array([k for _, k, _ in spans]), np.array(rows, float))
    taken: dict[int, set[int]] = {}
    for j in sorted(np.flatnonzero(score >= 0).tolist(),
                    key=lambda j: (-score[j], spans[j][0], -spans[j][2], spans[j][1])):
        s, k, e = spans[j]
        held = taken.setdefault(where[j], set())
        if held.isdisjoint(range(s, e)):
            held.update(range(s, e))
            found[where[j]].append((s, len(BASE_KINDS) + k, e))
    return [sorted(f) for f in found]


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                   ("end", pa.int64())]))


def _over_texts(make: Callable[[list[str], list], list], kind: pa.DataType):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in stretches(batches):
            yield pa.array(make(texts), kind)
    return run


def spans(text: Column, model: Model) -> Column:
    """Array of ``(kind, start, end)`` by start, then kind; null texts have none."""
    def make(texts: list[str | None]) -> list:
        return [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in row]
                for row in scan_texts([t or "" for t in texts], model)]
    return F.arrow_udf(_over_texts(make, _ARROW_SPANS), SPANS)(text)


def spans_text(found: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the given kinds, comma-joined."""
    return F.array_join(F.transform(
        F.filter(found, lambda s: s["kind"].isin(*kinds)),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                              s["end"].cast("string"))), ",")


def redact_text(text: str, found: list[tuple[int, int, int]]) -> str:
    """``text`` with each stretch of overlapping spans replaced by its first kind's mark."""
    out, at = [], 0
    for s, k, e in found:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k]}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with personal data in ``text_col`` replaced by marks; null texts stay null."""
    def make(texts: list[str | None]) -> list:
        found = scan_texts([t or "" for t in texts], model)
        return [None if t is None else redact_text(t, f) for t, f in zip(texts, found)]
    return df.withColumn(text_col, F.arrow_udf(_over_texts(make, pa.string()), "string")(
        F.col(text_col)))
