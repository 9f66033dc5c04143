"""Personal data in texts: fixed forms, and spans that a weakly supervised classifier adds.

Four fixed forms (e-mail, IP address, card number, phone number with a country code) always
stay. Spans of looser forms are candidates. Labelers built on regular expressions, word lists
and the words around a span vote for or against each candidate, or abstain. Spark counts
the vote patterns over the whole corpus, expectation-maximisation estimates from them how
far each labeler can be relied on, and a logistic classifier is trained on the resulting
probabilities and the span's own shape. Candidates that it accepts become spans.

The vote patterns are at most 3 ** labelers rows. The classifier is fitted on a sample of
``SAMPLE`` candidates, chosen by a hash; it judges every candidate.

Defined results: NULL and empty text has no spans; every row is judged by itself, repeated
rows alike; with no candidates at all, nothing is added.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmill.llm import arrays
from deskmill.session import materialized

Span = tuple[str, int, int]

#: Candidates that the classifier is fitted on at most.
SAMPLE = 20_000
#: Probability from which a candidate becomes a span.
ACCEPT = 0.9
#: Characters before and after a span in which labelers look for words.
CONTEXT = 40

#: Kinds in the order in which spans are listed; the first four are fixed forms.
KINDS = ["email", "ip", "card", "phone", "email_spelled", "phone_local", "national_id", "iban", "person"]
BASE = KINDS[:4]

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Looser forms; all are bounded in length.
LOOSE = {
    "email_spelled": re.compile(r"\b[A-Za-z0-9._-]{2,40} ?[\[(]at[\])] ?[A-Za-z0-9-]{2,40}(?: ?[\[(]dot[\])] ?[A-Za-z]{2,10}){1,3}", re.I),
    "phone_local": re.compile(r"(?<![\w.+-])(?:\([0-9]{2,5}\)[ -]?|0[0-9]{1,4}[ /-])[0-9]{2,5}(?:[ -][0-9]{2,5}){1,3}(?![\w-])"),
    "national_id": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "person": re.compile(r"(?<!\w)(?:Mr|Mrs|Ms|Dr|Herr|Frau|Señor|Señora|Monsieur|Madame)\.? [A-Z]\w{1,30}(?: [A-Z]\w{1,30}){0,2}"),
}

#: Word lists of the labelers, plain and together.
TITLES = "mr mrs ms dr herr frau señor señora monsieur madame".split()
IBAN_COUNTRIES = "AT BE CH CZ DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split()
TOP_DOMAINS = "com org net edu gov info io de fr es uk eu".split()
FOR_WORDS = {
    "email_spelled": "mail email e-mail contact write correo courriel kontakt".split(),
    "phone_local": "phone tel call mobile fax cell telefon handy téléphone teléfono anruf llame".split(),
    "national_id": "ssn social security taxpayer identity".split(),
    "iban": "iban account konto compte cuenta bank transfer".split(),
    "person": "name contact dear signed patient client customer sincerely regards".split(),
}
AGAINST_WORDS = "version isbn issn chapter section page figure rfc build release serial part model line".split()

WORD = re.compile(r"[^\W\d_][\w-]*")
_BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _up_to_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _emails(text: str) -> list[Span]:
    """Leftmost matches, found from each ``@`` leftwards, so that long words cost no retries."""
    found, end = [], 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > end and _BEFORE_AT.match(text[start - 1]):
            start -= 1
        if start < m.start():
            found.append(("email", start, m.end()))
            end = m.end()
    return found


def base_spans(text: str) -> list[Span]:
    """The fixed forms, by kind as listed, then by start."""
    spans = _emails(text) if "@" in text else []
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(_up_to_255(p) for p in m[0].split("."))]
    cards = ((m, _digits(m[0])) for m in CARD.finditer(text))
    spans += [("card", *m.span()) for m, d in cards if 13 <= len(d) <= 19 and luhn(d)]
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return spans


def candidates(text: str, taken: list[Span]) -> list[Span]:
    """Matches of the looser forms that overlap neither the fixed forms nor each other."""
    found = sorted(((kind, *m.span()) for kind, form in LOOSE.items() for m in form.finditer(text)), key=lambda s: (s[1], KINDS.index(s[0])))
    taken = sorted(s[1:] for s in taken)
    free, end, k = [], 0, 0
    for span in found:
        while k < len(taken) and taken[k][1] <= span[1]:
            k += 1
        if span[1] >= end and not (k < len(taken) and taken[k][0] < span[2]):
            free.append(span)
            end = span[2]
    return free


# -- labelers: 1 for, -1 against, 0 abstains --------------------------------------------------


def _by_form(kind: str, span: str) -> int:
    """Regular expressions and check sums."""
    digits = _digits(span)
    if kind == "iban":
        compact = span.replace(" ", "")
        moved = compact[4:] + compact[:4]
        return 1 if int("".join(str(int(c, 36)) for c in moved)) % 97 == 1 else -1
    if kind == "national_id":
        return -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 1
    if kind == "phone_local":
        return 1 if 8 <= len(digits) <= 12 else -1
    return 0


def _by_list(kind: str, span: str) -> int:
    """Gazetteers."""
    if kind == "iban":
        return 1 if span[:2] in IBAN_COUNTRIES else -1
    if kind == "email_spelled":
        return 1 if WORD.findall(span.lower())[-1] in TOP_DOMAINS else -1
    if kind == "person":
        return 1 if span.split()[0].rstrip(".").lower() in TITLES else 0
    return 0


def _by_words_for(kind: str, before: list[str], after: list[str]) -> int:
    return 1 if any(w in FOR_WORDS[kind] for w in before + after[:2]) else 0


def _by_words_against(before: list[str], after: list[str]) -> int:
    return -1 if any(w in AGAINST_WORDS for w in before[-3:]) else 0


def _by_repetition(span: str) -> int:
    """Runs of one digit are made up."""
    digits = _digits(span)
    return -1 if len(digits) >= 6 and max(Counter(digits).values()) > 0.7 * len(digits) else 0


def votes(text: str, span: Span) -> list[int]:
    kind, start, end = span
    own = text[start:end]
    before = WORD.findall(text[max(0, start - CONTEXT) : start].lower())
    after = WORD.findall(text[end : end + CONTEXT].lower())
    return [
        _by_form(kind, own),
        _by_list(kind, own),
        _by_words_for(kind, before, after),
        _by_words_against(before, after),
        _by_repetition(own),
    ]


LABELERS = 5


def features(text: str, span: Span, vote: list[int]) -> list[float]:
    """What the classifier sees: the votes, the kind, and the shape of the span."""
    kind, start, end = span
    own = text[start:end]
    digits = len(_digits(own))
    out = [1.0] + [float(v == 1) for v in vote] + [float(v == -1) for v in vote] + [float(kind == k) for k in KINDS[4:]]
    return [*out, digits / len(own), min(len(own), 40) / 40, float(start == 0 or text[start - 1].isspace()), float(len(set(own)) / len(own))]


# -- learning ---------------------------------------------------------------------------------


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Chances of each vote given the truth, ``[labeler, truth, vote + 1]``, and the share that is true.

    Expectation-maximisation on distinct vote patterns and their counts. It starts from
    labelers that are right more often than not and keeps pseudo-counts, so that few
    candidates leave the estimate near that start.
    """
    chance = np.zeros((patterns.shape[1], 2, 3))
    chance[:, 0] = (0.45, 0.4, 0.15)
    chance[:, 1] = (0.15, 0.4, 0.45)
    start, share = chance * 20, 0.5
    for _ in range(rounds):
        true = probability(patterns, chance, share)
        share = (10 + (counts * true).sum()) / (20 + counts.sum())
        for k in range(patterns.shape[1]):
            for vote in (-1, 0, 1):
                same = patterns[:, k] == vote
                chance[k, 1, vote + 1] = start[k, 1, vote + 1] + (counts * true)[same].sum()
                chance[k, 0, vote + 1] = start[k, 0, vote + 1] + (counts * (1 - true))[same].sum()
        chance /= chance.sum(axis=2, keepdims=True)
    return chance, share


def probability(patterns: np.ndarray, chance: np.ndarray, share: float) -> np.ndarray:
    """That a candidate with these votes is personal data."""
    odds = np.full(len(patterns), np.log(share / (1 - share)))
    for k in range(patterns.shape[1]):
        odds += np.log(chance[k, 1, patterns[:, k] + 1] / chance[k, 0, patterns[:, k] + 1])
    return 1 / (1 + np.exp(-odds))


def fit(seen: np.ndarray, wanted: np.ndarray, steps: int = 400, penalty: float = 1e-3) -> np.ndarray:
    """Weights of a logistic classifier for probabilities as targets, by Newton's method."""
    weights = np.zeros(seen.shape[1])
    for _ in range(min(steps, 25)):
        made = 1 / (1 + np.exp(-seen @ weights))
        slope = seen.T @ (made - wanted) / len(seen) + penalty * weights
        bend = (seen * (made * (1 - made))[:, None]).T @ seen / len(seen) + penalty * np.eye(len(weights))
        weights = weights - np.linalg.solve(bend, slope)
    return weights


_SPAN = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
_CANDIDATE = pa.list_(pa.struct([*_SPAN, ("votes", pa.list_(pa.int8())), ("seen", pa.list_(pa.float64()))]))
_FOUND = (
    "doc_id long, base array<struct<kind: string, start: long, end: long>>, "
    "candidates array<struct<kind: string, start: long, end: long, votes: array<tinyint>, seen: array<double>>>"
)

_MARKED = arrays.byte_table("@+0123456789")
_NEEDLES = [f"{t} ".encode() for t in ("Mr", "Mrs", "Ms", "Dr", "Mr.", "Mrs.", "Ms.", "Dr.", "Herr", "Frau", "Señor", "Señora", "Monsieur", "Madame")]
_SPELLED = [b"(at)", b"[at]"]


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    """Texts that could hold a span; an empty one for all others."""
    data, offsets = arrays.utf8(batch.column("text"))
    look = arrays.rows_with_byte(data, offsets, _MARKED) | arrays.rows_with(data, offsets, *_NEEDLES)
    look |= arrays.rows_with(arrays.LOWER[data], offsets, *_SPELLED)
    for i in range(batch.num_rows):
        yield data[offsets[i] : offsets[i + 1]].tobytes().decode() if look[i] else ""


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in arrays.slices(batches, "text"):
        base, more = [], []
        for text in _texts(batch):
            fixed = base_spans(text) if text else []
            base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in fixed])
            loose = []
            for span in candidates(text, fixed) if text else []:
                vote = votes(text, span)
                loose.append(dict(zip(("kind", "start", "end"), span, strict=True)) | {"votes": vote, "seen": features(text, span, vote)})
            more.append(loose)
        columns = [batch.column("doc_id"), pa.array(base, pa.list_(pa.struct(_SPAN))), pa.array(more, _CANDIDATE)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "candidates"])


def train(found: DataFrame, sample: int = SAMPLE) -> np.ndarray | None:
    """Classifier weights from all candidates' votes; ``None`` if there are no candidates."""
    each = found.select("doc_id", F.explode("candidates").alias("c")).select("doc_id", "c.*")
    rows = each.groupBy("votes").count().collect()
    if not rows:
        return None
    patterns = np.array([r["votes"] for r in rows], np.int64)
    chance, share = reliabilities(patterns, np.array([r["count"] for r in rows], float))
    chosen = each.orderBy(F.xxhash64("doc_id", "start"), "start").select("votes", "seen").limit(sample).collect()
    wanted = probability(np.array([r["votes"] for r in chosen], np.int64), chance, share)
    return fit(np.array([r["seen"] for r in chosen]), wanted)


def _accepted(seen: np.ndarray, weights: np.ndarray | None, accept: float) -> np.ndarray:
    return np.zeros(len(seen), bool) if weights is None else 1 / (1 + np.exp(-seen @ weights)) >= accept


_RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _judge(weights: np.ndarray | None, accept: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for base, more in zip(batch.column("base").to_pylist(), batch.column("candidates").to_pylist(), strict=True):
                spans = [(s["kind"], s["start"], s["end"]) for s in base]
                kinds = Counter(s[0] for s in spans)
                added = []
                if more:
                    good = _accepted(np.array([c["seen"] for c in more]), weights, accept)
                    added = [(c["kind"], c["start"], c["end"]) for c, ok in zip(more, good, strict=True) if ok]
                added.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
                values = [*(kinds[k] for k in BASE), hashlib.sha256(joined(spans).encode()).hexdigest(), joined(spans + added), len(added)]
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            made = [pa.array(v, t) for v, t in zip(out, types, strict=True)]
            names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names)

    return run


def _searched(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialized(docs.mapInArrow(_find, _FOUND), "spans")


def personal_data(docs: DataFrame, accept: float = ACCEPT, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: counts of the fixed forms, and all spans as text."""
    found = _searched(docs)
    return found.mapInArrow(_judge(train(found, sample), accept), _RESULT)


def _redact(weights: np.ndarray | None, accept: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.slices(batches, "text"):
            out = batch.column("text").to_pylist()
            for i, text in enumerate(_texts(batch)):
                if not text:
                    continue
                spans = base_spans(text)
                more = candidates(text, spans)
                if more:
                    good = _accepted(np.array([features(text, s, votes(text, s)) for s in more]), weights, accept)
                    spans = spans + [s for s, ok in zip(more, good, strict=True) if ok]
                out[i] = masked(out[i], spans)
            place = batch.schema.get_field_index("text")
            yield batch.set_column(place, batch.schema.field(place), pa.array(out, batch.column("text").type))

    return run


def masked(text: str, spans: list[Span]) -> str:
    """The text with each stretch of spans replaced by the name of the kind that begins it."""
    parts, end = [], 0
    for kind, start, stop in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= end:
            parts += [text[end:start], f"<{kind.upper()}>"]
        end = max(end, stop)
    return "".join([*parts, text[end:]]) if spans else text


def redacted(docs: DataFrame, accept: float = ACCEPT, sample: int = SAMPLE) -> DataFrame:
    """All rows and columns of ``docs``, with the spans of personal data in ``text`` masked."""
    weights = train(_searched(docs), sample)
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_redact(weights, accept), fields)
