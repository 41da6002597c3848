"""Personal information in free text: spans are proposed by patterns, confirmed by checksums and judged by the words around them.

A proposal starts with its pattern's score. A valid checksum (Luhn, mod 97, weighted mod 11) and a context word nearby raise
it, a word of another kind of number (ISBN, DOI, shelf mark) lowers it; from `THRESHOLD` on it is a mention. Person names are
read from a text's words by class (given name, family name, initial, particle, title, capitalised word): a table of names
gives the first two, titles and words that introduce a person make up for a missing or ambiguous entry. The table goes to the
tasks as sorted 64-bit hashes while it is small, and is joined with the words of the texts beyond that.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Container, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.6
CONTEXT_CHARS = 60
KINDS = ("email", "phone", "id_number", "address", "name")

# ---- checksums -------------------------------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    """Luhn's check over a string of digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return bool(digits) and total % 10 == 0


def mod97(digits: str) -> bool:
    """The last two digits complete the rest to a multiple of 97."""
    return len(digits) > 2 and (int(digits[:-2]) + int(digits[-2:])) % 97 == 0


def mod11(digits: str) -> bool:
    """Two final digits by weights falling to 2 from the right, mod 11."""

    def last(body: str) -> int:
        rest = sum(int(c) * w for c, w in zip(reversed(body), range(2, 2 + len(body)), strict=True)) * 10 % 11
        return rest % 10

    return len(digits) == 11 and last(digits[:9]) == int(digits[9]) and last(digits[:10]) == int(digits[10])


# ---- patterns of e-mail addresses, numbers and addresses -------------------------------------------------------------

_S = r"[\s ]"
_LOCAL = r"[^\W_](?:[\w.+%'-]*\w)?"
_LABEL = r"[^\W_](?:[\w-]*[^\W_])?"
EMAIL = re.compile(
    rf"""(?<![\w@.+-]){_LOCAL}
    (?: {_S}?@{_S}?{_LABEL}(?:\.{_LABEL})*\.[^\W\d_]{{2,}}
      | {_S}*[(\[{{<]{_S}*(?:at|@){_S}*[)\]}}>]{_S}*{_LABEL}(?:(?:\.|{_S}*[(\[{{<]{_S}*(?:dot|\.){_S}*[)\]}}>]{_S}*|{_S}+(?:dot|DOT){_S}+){_LABEL})*
      | {_S}+(?:AT|at){_S}+{_LABEL}(?:{_S}+(?:DOT|dot){_S}+{_LABEL})+ )(?![\w@])""",
    re.VERBOSE | re.IGNORECASE,
)

#: What stands between the two parts of an address; the pattern is tried where the word before it begins.
EMAIL_SIGN = re.compile(rf"@|[(\[{{<]{_S}*at{_S}*[)\]}}>]|{_S}at{_S}+\S+{_S}+dot{_S}", re.IGNORECASE)
LOCAL_CHARS = frozenset("._+%'-")

#: (pattern, score): telephone numbers by shape.
PHONES = [
    (r"\+\d{1,3}[\s .-]?(?:\(\d{1,4}\)[\s .-]?)?\d{1,5}(?:[\s .-]?\d{2,8}){1,4}", 0.8),
    (r"00\d{1,3}(?:[\s .-]\d{2,5}){2,4}", 0.7),
    (r"\(0?\d{2,5}\)[\s .-]?\d{3,8}(?:[\s .-]\d{3,5})?", 0.7),
    (r"0\d{4}[\s ]\d{3}[\s ]\d{3}", 0.7),
    (r"0\d{1,4}[\s /]\d{4,8}(?:-\d{1,4})?", 0.6),
    (r"0\d(?:[\s .]\d{2}){4}", 0.7),
    (r"[2-9]\d{2}([-.\s ])[2-9]\d{2}\1\d{4}", 0.7),
    (r"1[2-9]\d{2}[2-9]\d{6}", 0.6),
]
PHONE = [(re.compile(rf"(?<![\w./+(-]){p}(?:,?[\s ]*(?:ext|x|Durchwahl|poste)\.?[\s ]*\d{{1,5}})?(?![\w/]|[-.]\d)"), s) for p, s in PHONES]
PHONE_WORDS = re.compile(r"\b(?:phone|tel|télé?|telefon\w*|teléfono|fax|call|mobile|cell|reach)\b", re.IGNORECASE)

#: (pattern, score, checksum): identity numbers by shape.
IDS = [
    (r"\d{3}([-\s ])\d{2}\1\d{4}", 0.6, None),
    (r"[A-Z]{2}[\s ]?\d{2}[\s ]?\d{2}[\s ]?\d{2}[\s ]?[A-D]", 0.6, None),
    (r"[A-Z]{1,2}\d{7,8}", 0.4, None),
    (r"\d{3}\.\d{3}\.\d{3}-\d{2}", 0.6, mod11),
    (r"\d{6}-\d{4}-[\dA-Z]", 0.6, None),
    (r"\d{2}-\d{7}", 0.4, None),
    (r"\d{9}", 0.2, luhn),
    (r"[12][\s ]?\d{2}[\s ]?\d{2}[\s ]?\d{2}[\s ]?\d{3}[\s ]?\d{3}[\s ]?\d{2}", 0.2, mod97),
    (r"\d{2}\.\d{2}\.\d{2}-\d{3}\.\d{2}", 0.4, mod97),
]
ID = [(re.compile(rf"(?<![\w./+(-]){p}(?![\w/]|[-.]\d)"), s, f) for p, s, f in IDS]
ID_WORDS = re.compile(
    r"\b(?:passport|identity|insurance|social|tax|ssn|nino|versicherungsnummer|sozialversicherung\w*|steuer\w*|ausweis\w*|reisepass|passeport|identité|sécurité|"
    r"assuré\w*|fiscal\w*|identidad|pasaporte|seguridad|documento|dni|nif|forms?|number\s+of\s+(?:mr|ms|mrs|dr))\b",
    re.IGNORECASE,
)
OTHER_WORDS = re.compile(r"(?:\b(?:isbn|issn|doi|shelf\s+mark|pages?|accession|ticket|version|release|grant|vol(?:ume)?)[\s .:#]*|10\.\d{4,9}/\S*)$", re.IGNORECASE)

_W = r"[^\W\d_][\w'’-]*"
_TYPE = r"(?:street|st|road|rd|lane|ln|row|avenue|ave|close|crescent|cres|terrace|drive|way|place|square|sq|court|ct|boulevard|blvd|gardens?|hill|mews|walk|parade|grove|quay)\.?"
_UNIT = r"(?:flat|apt\.?|apartment|unit|suite|room)"
_SEP = rf"{_S}*,?{_S}+"
#: A place: a word, some second words of places, a postcode after it.
_PLACE = rf"{_W}(?:{_S}+(?:bay|beach|city|town|hill|heath|green|park|falls|springs)(?!\w))?(?:{_S}+[a-z]{{1,2}}\d{{1,2}}[a-z]?{_S}+\d[a-z]{{2}}(?!\w))?"
ADDRESSES = [
    rf"(?:{_UNIT}{_S}+\w{{1,5}}{_SEP})?\d{{1,5}}[a-z]?{_S}+(?:{_W}{_S}+){{1,6}}?{_TYPE}(?!\w)(?:{_SEP}{_UNIT}{_S}+\w{{1,5}})?{_SEP}{_PLACE}",
    rf"[^\W\d_][\w-]*(?:stra(?:ß|ss)e|str\.|gasse|weg|platz|allee|ufer|damm){_S}+\d{{1,4}}[a-z]?{_S}*,{_S}*\d{{5}}{_S}+{_PLACE}",
    rf"\d{{1,4}}(?:{_S}?(?:bis|ter))?,?{_S}+(?:rue|avenue|boulevard|quai|impasse|allée|place|chemin|cours){_S}+{_W}(?:{_S}+{_W}){{0,5}}{_S}*,{_S}*\d{{5}}{_S}+{_PLACE}",
    rf"(?:calle|avenida|plaza|paseo|camino|ronda|c/){_S}+{_W}(?:{_S}+{_W}){{0,5}}?,?{_S}*(?:núm\.|nº|n\.º|no\.)?{_S}*\d{{1,4}}{_S}*,{_S}*(?:\d{{5}}{_S}+)?{_PLACE}",
]
ADDRESS = [re.compile(rf"(?<![\w./-]){p}", re.IGNORECASE) for p in ADDRESSES]

# ---- names -----------------------------------------------------------------------------------------------------------

TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))*")
TITLES = frozenset("mr mrs ms miss dr prof professor mx sir herr frau mme mlle madame monsieur sr sra señor señora don doña".split())
PARTICLES = frozenset("van von der den de la le du del della di da dos mac mc ten ter el al bin ibn st".split())
#: Words right before a name that introduce a person: greetings and closings, thanks, roles, and words for who did, got or said something.
CUES = frozenset(
    "dear hello hi hey liebe lieber sehr geehrte geehrter cher chère estimado estimada querido querida "
    "signed regards wishes sincerely yours faithfully cheers grüße gruß cordialement salutations saludos atentamente "
    "thank thanks danken danke dank remercions merci agradecemos gracias "
    "reviewer referee author editor contact attn correspondence korrespondenz correspondance correspondencia interviewer sender recipient "
    "by von par por with mit avec con to an à from as".split()
)
BETWEEN = re.compile(r"[\s,:;–-]*")  # what may stand between it and the name
#: Names that are everyday words too; in lower case they are names only where a person is introduced.
EVERYDAY = frozenset(
    "art banks bill black brown bush christian cook day drew east faith field ford fox frank gene grace green hill hope hunt iris jack joy june king lane little long "
    "love mark marsh may north page pat power price rich rose sharp short small stone sue summer west white will winter wolf wood woods young".split()
)
_FAM = "(?:P )*[FB]"
#: Class strings (a letter for each word, then what stands between it and the next one) of names made up of lexicon entries.
FULL = re.compile(
    rf"[GB] (?:I\.)*{_FAM}"  # Given M. Family
    rf"|(?:I\.)+{_FAM}"  # G. M. Family
    rf"|{_FAM},(?:[GB](?: I\.)*|(?:I\.)+)"  # Family, Given
    rf"|{_FAM} [GB](?: I\.)*"  # FAMILY Given
)
SINGLE = re.compile(rf"{_FAM}|[GB]")
TITLED = re.compile(r"(?:[CGFB] )?(?:I\.)*(?:P )*[CGFB]|(?:I\.)+(?:P )*[CGFB]")
INITIALLED = re.compile(r"(?:C )?(?:I\.)+(?:P )*C")
#: Where any of them can begin.
BEGINS = re.compile(r"[GBFIP]|C(?= I\.)|(?<=T[ .])C")


@dataclass(frozen=True)
class Span:
    start: int
    end: int
    kind: str
    score: float


class Kinds(dict):
    """The class of each word, found out once: T title, B given and family name, G given, F family, P particle, C capitalised, w any other."""

    def __init__(self, given: Container[str] = frozenset(), family: Container[str] = frozenset()):
        super().__init__()
        self.given, self.family = given, family

    def __missing__(self, word: str) -> str:
        low = folded(word)
        if low in TITLES:
            kind = "T"
        elif low in self.given:
            kind = "B" if low in self.family else "G"
        elif low in self.family:
            kind = "F"
        else:
            kind = "P" if low in PARTICLES else "C" if word[0].isupper() else "w"
        self[word] = kind
        return kind


def folded(word: str) -> str:
    """A word as it is in the table of names."""
    return word.lower().replace("’", "'")


def _classes(text: str, kinds: Kinds) -> tuple[list, str]:
    words, out = [], []
    matches = list(TOKEN.finditer(text))
    for k, m in enumerate(matches):
        word, end = m.group(), m.end()
        words.append((m.start(), end, word))
        kind = "I" if len(word) == 1 and word.isupper() and text[end : end + 1] == "." else kinds[word]
        if kind == "w":  # what follows such a word is never part of a name
            out.append("w|")
            continue
        after = text[end : matches[k + 1].start()] if k + 1 < len(matches) else "\n"
        bare = after.strip()
        out.append(kind + (" " if after and not bare else "." if bare in (".", ".-") and kind in "IT" else "," if bare == "," and after != "," else "|"))
    return words, "".join(out)


def _capital(words: list, first: int, last: int) -> bool:
    return all(w[0].isupper() for _, _, w in words[first:last] if w.lower() not in PARTICLES)


def names(text: str, kinds: Kinds) -> list[Span]:
    """Person names of a text, without titles."""
    words, coded = _classes(text, kinds)
    found: list[Span] = []

    def introduced(k: int) -> bool:
        if k and coded[2 * (k - 1)] == "T":
            k -= 1
        return k > 0 and words[k - 1][2].lower() in CUES and BETWEEN.fullmatch(text, words[k - 1][1], words[k][0]) is not None

    done = 0
    for begin in BEGINS.finditer(coded):
        k = begin.start() // 2
        if begin.start() % 2 or k < done:
            continue
        titled = k > 0 and coded[2 * k - 2] == "T" and coded[2 * k - 1] in " ."
        best = None
        for pattern, score in ((FULL, 0.8), (SINGLE, 0.2), (TITLED, 0.2), (INITIALLED, 0.3)):
            if pattern is TITLED and not titled:
                continue
            m = pattern.match(coded, 2 * k)
            if not m:
                continue
            last = (m.end() + 1) // 2
            if not _capital(words, k, last):
                if pattern is not FULL:
                    continue
                score -= 0.4 if all(w.lower() in EVERYDAY for _, _, w in words[k:last]) else 0.2
            score += 0.5 * titled + 0.4 * introduced(k)
            if score >= THRESHOLD:
                best = (last, score)
                break
        if best:
            last, score = best
            end = words[last - 1][1]
            if coded[2 * (last - 1)] == "I" and text[end : end + 1] == ".":
                end += 1
            found.append(Span(words[k][0], end, "name", min(1.0, round(score, 2))))
            done = last
    return found


# ---- all kinds -------------------------------------------------------------------------------------------------------


#: Where numbers of six digits or more stand; patterns are tried only around these.
DIGITS = re.compile(r"\d(?:[\s .()/-]{0,3}\d){5,}")
BEFORE, AFTER = 6, 24
DIGIT = re.compile(r"\d")


def _judge(text: str, kind: str, m: re.Match, score: float, words: re.Pattern, near: int, bonus: float, confirmed: bool) -> Span:
    before = text[max(0, m.start() - CONTEXT_CHARS) : m.start()]
    score += bonus * bool(words.search(before[-near:])) - 0.6 * bool(OTHER_WORDS.search(before)) + 0.3 * confirmed
    return Span(m.start(), m.end(), kind, score)


def _numbers(text: str) -> Iterator[Span]:
    for region in DIGITS.finditer(text):
        first, last = max(0, region.start() - BEFORE), min(len(text), region.end() + AFTER)
        for pattern, score, checksum in ID:
            for m in pattern.finditer(text, first, last):
                confirmed = bool(checksum) and checksum(re.sub(r"\D", "", m.group()))
                yield _judge(text, "id_number", m, score, ID_WORDS, CONTEXT_CHARS, 0.5, confirmed)
        for pattern, score in PHONE:
            for m in pattern.finditer(text, first, last):
                yield _judge(text, "phone", m, score, PHONE_WORDS, 25, 0.2, False)


#: Words of an address that need no capital.
SMALL = PARTICLES | frozenset("rue avenue boulevard quai impasse allée place chemin cours calle avenida plaza paseo camino ronda núm no bis ter flat apt apartment unit suite room des les las los y et".split())


def _is_named(match: re.Match) -> bool:
    """The street's and the place's words begin with capitals."""
    words = [w for w in TOKEN.findall(match.group()) if len(w) > 1 and w.lower() not in SMALL]
    return bool(words) and all(w[0].isupper() for w in words)


def _emails(text: str) -> Iterator[Span]:
    for sign in EMAIL_SIGN.finditer(text):
        end = sign.start()
        while end and text[end - 1].isspace():
            end -= 1
        start = end
        while start and (text[start - 1].isalnum() or text[start - 1] in LOCAL_CHARS):
            start -= 1
        for i in range(start, end):
            if (i == start or text[i - 1] in "%'") and (m := EMAIL.match(text, i)) and m.end() > sign.start():
                yield Span(m.start(), m.end(), "email", 0.9)
                break


#: For each address pattern, words of which its texts have one (in lower case).
ADDRESS_WORDS = [
    None,
    ("straße", "strasse", "str.", "gasse", "weg", "platz", "allee", "ufer", "damm"),
    ("rue", "avenue", "boulevard", "quai", "impasse", "allée", "place", "chemin", "cours"),
    ("calle", "avenida", "plaza", "paseo", "camino", "ronda", "c/"),
]


def _addresses(text: str) -> Iterator[Span]:
    low = text.lower()
    for pattern, needed in zip(ADDRESS, ADDRESS_WORDS, strict=True):
        if needed and not any(w in low for w in needed):
            continue
        at = 0
        while m := pattern.search(text, at):
            if _is_named(m):
                yield Span(m.start(), m.end(), "address", 0.8)
            at = m.end() if _is_named(m) else m.start() + 1


def mentions(text: str | None, kinds: Kinds | None = None) -> list[Span]:
    """All mentions in a text, in order, none overlapping another; of two that do, the stronger kind (in the order e-mail, address, higher score) stays."""
    if not text:
        return []
    taken: list[Span] = []  # in order

    def take(spans: list[Span]) -> None:
        for s in sorted(spans, key=lambda s: (-s.score, s.start - s.end)):
            if s.score < THRESHOLD:
                break
            at = bisect_left(taken, s.start, key=lambda t: t.start)
            if (at == 0 or taken[at - 1].end <= s.start) and (at == len(taken) or taken[at].start >= s.end):
                taken.insert(at, s)

    take(list(_emails(text)))
    if DIGIT.search(text):
        take(list(_addresses(text)))
        take(list(_numbers(text)))
    rest, at = [], 0
    for t in taken:
        rest += [text[at : t.start], "\0" * (t.end - t.start)]
        at = t.end
    take(names("".join([*rest, text[at:]]), kinds if kinds is not None else Kinds()))
    return taken


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span replaced by its kind in brackets, all else unchanged."""
    if text is None:
        return None
    out, at = [], 0
    for s in spans:
        out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = s.end
    return "".join([*out, text[at:]])


# ---- over tables -----------------------------------------------------------------------------------------------------


#: Names that are sent to the tasks as they are (9 bytes each); a larger table is joined with the texts' words.
BROADCAST_NAMES = 4_000_000
TEXTS_AT_A_TIME = 512
SALTS = 32
SEED = 42  # fixed value: the seed of Spark's xxhash64
SPANS = "doc_id bigint, kind string, start_char int, end_char int, score double"


def name_table(people: DataFrame, given: str, family: str) -> DataFrame:
    """`(h, flags)`: the 64-bit hash of every name word of a table of people; flags 1 given name, 2 family name, 3 both.

    Given names count by their first word, family names by their last; single letters and nulls are no names.
    """
    word = lambda c, at: F.translate(F.lower(F.element_at(F.split(F.trim(F.col(f"`{c}`")), r"\s+"), at)), "’", "'")
    both = F.array(F.struct(word(given, 1).alias("n"), F.lit(1).alias("f")), F.struct(word(family, -1).alias("n"), F.lit(2).alias("f")))
    pairs = people.select(F.explode(both).alias("x")).where("length(x.n) > 1")
    return pairs.groupBy(F.xxhash64("x.n").alias("h")).agg(F.bit_or("x.f").alias("flags"))


def word_hash(word: str) -> int:
    """What Spark's xxhash64 makes of a word."""
    return xxhash.xxh64_intdigest(word.encode(), SEED)


def _sorted_names(names: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = names.toArrow()
    h = table["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], table["flags"].to_numpy().astype(np.int8)[order]


def _kinds_of(texts: list[str | None], h: np.ndarray, flags: np.ndarray) -> Kinds:
    """The classes of the words of some texts: their distinct words are looked up together by binary search."""
    words = list({folded(w) for t in texts if t for w in TOKEN.findall(t)})
    hashes = np.fromiter(map(word_hash, words), np.uint64, len(words))
    at = np.minimum(np.searchsorted(h, hashes), max(len(h) - 1, 0))
    found = np.flatnonzero(h[at] == hashes) if len(h) else []
    kinds = Kinds(set(), set())
    for i in found:
        if flags[at[i]] & 1:
            kinds.given.add(words[i])
        if flags[at[i]] & 2:
            kinds.family.add(words[i])
    return kinds


def _with_broadcast(make, broadcast):
    """Batches `(id, text)` in parts, each with the classes of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, flags = broadcast.value
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS_AT_A_TIME):
                part = batch.slice(start, TEXTS_AT_A_TIME)
                texts = part.column(1).to_pylist()
                kinds = _kinds_of(texts, h, flags)
                yield make(part.column(0), texts, [mentions(t, kinds) for t in texts])

    return run


def _with_joined(make):
    """Batches `(id, text, known)`, `known` the names among the text's words as (hash, flags)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(1).to_pylist(), []
            for text, known in zip(texts, batch.column(2).to_pylist(), strict=True):
                pairs = sorted((k["h"] & (1 << 64) - 1, k["flags"]) for k in known or [])
                spans.append(mentions(text, _kinds_of([text], np.array([a for a, _ in pairs], np.uint64), np.array([b for _, b in pairs], np.int8))))
            yield make(batch.column(0), texts, spans)

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, h): each different word of each text, by hash."""
    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS_AT_A_TIME):
            part = batch.slice(start, TEXTS_AT_A_TIME)
            row, h = [], []
            for i, text in enumerate(part.column(2).to_pylist()):
                words = {folded(w) for w in TOKEN.findall(text or "")}
                row += [i] * len(words)
                h += map(word_hash, words)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(np.array(h, np.uint64).view(np.int64))], names=["k1", "k2", "h"])


def _run(documents: DataFrame, names: DataFrame | None, doc_id: str, text: str, make, schema: str, most: int) -> DataFrame:
    spark = documents.sparkSession
    docs = documents.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    if names is None:
        names = spark.createDataFrame([], "h bigint, flags int")
    names = names.persist()  # small beside the texts; spills to disk
    if names.count() <= most:
        held = spark.sparkContext.broadcast(_sorted_names(names))
        names.unpersist()
        return docs.mapInArrow(_with_broadcast(make, held), schema)
    # Equal texts have equal keys and share one answer. A word of very many texts is spread over SALTS tasks.
    keys: list[Column] = [F.xxhash64("text").alias("k1"), F.xxhash64("text", F.lit(1)).alias("k2")]
    words = docs.select(*keys, "text").mapInArrow(_words, "k1 bigint, k2 bigint, h bigint").withColumn("salt", F.pmod("k1", F.lit(SALTS)))
    salted = names.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(SALTS)])))
    known = words.join(salted, ["h", "salt"]).groupBy("k1", "k2").agg(F.collect_set(F.struct("h", "flags")).alias("known"))
    found = docs.select("*", *keys).join(known, ["k1", "k2"], "left").select("doc_id", "text", "known")
    return found.mapInArrow(_with_joined(make), schema)


def _listed(ids: pa.Array, texts: list, spans: list[list[Span]]) -> pa.RecordBatch:
    rows = [(n, s.kind, s.start, s.end, s.score) for n, of in enumerate(spans) for s in of]
    at, kind, start, end, score = zip(*rows, strict=True) if rows else [()] * 5
    columns = [ids.take(pa.array(at, pa.int64())), pa.array(kind, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(score, pa.float64())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "kind", "start_char", "end_char", "score"])


def find_mentions(documents: DataFrame, names: DataFrame | None = None, *, doc_id: str = "doc_id", text: str = "text", broadcast_names: int = BROADCAST_NAMES) -> DataFrame:
    """`(doc_id, kind, start_char, end_char, score)` of each mention; nothing for null and empty texts, whole texts however long.

    `names` is a `name_table`. Up to `broadcast_names` of them go to the tasks; more are joined with the words of the texts, with
    the same result.
    """
    return _run(documents, names, doc_id, text, _listed, SPANS, broadcast_names)


def _redacted(ids: pa.Array, texts: list, spans: list[list[Span]]) -> pa.RecordBatch:
    new = [redact(t, s) for t, s in zip(texts, spans, strict=True)]
    return pa.RecordBatch.from_arrays([ids, pa.array(new, pa.string()), pa.array([len(s) for s in spans], pa.int32())], names=["doc_id", "text", "n_mentions"])


def redact_documents(documents: DataFrame, names: DataFrame | None = None, *, doc_id: str = "doc_id", text: str = "text", broadcast_names: int = BROADCAST_NAMES) -> DataFrame:
    """`(doc_id, text, n_mentions)`: every document, mentions replaced by typed placeholders; a null text stays null. `names` as in `find_mentions`."""
    return _run(documents, names, doc_id, text, _redacted, "doc_id bigint, text string, n_mentions int", broadcast_names)
