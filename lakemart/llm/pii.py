"""Personal data replaced by keyed surrogates of the same type.

Entities are found by patterns: mail addresses, telephone, card, social-security
numbers, network addresses, and names behind titles, which tell the gender: all
capitalised words and initials there, and the same words, capitalised, anywhere
else in the document, with initials in front of them.  A word has one surrogate,
whatever its titles: its gender is the one that most places tell, if any.
Each distinct entity, in one canonical form, gets a surrogate from an HMAC of
its kind, form and the number of the attempt: digits for digits, letters of the
same script for letters, names built from syllables of the script with an ending
of the gender, card numbers with a valid check digit if they had one.

A surrogate that equals another one or an entity of the corpus is a collision:
all but one of them go into another attempt, until none is left.  Later attempts
are longer, so none is ever without a free surrogate.  Mail domains are entities
of their own: one domain stays one, and two stay two.  So different entities stay
different, and one entity has one surrogate everywhere; each place keeps its own
format (separators, brackets, capitals).

NULL text stays NULL.  Repeated rows each count.  Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import string
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import set_aside, ship, slices, stored

# Attempts after which a form gets one character more: letters, and digits, whose number tells the type.
LETTERS_GROW, DIGITS_GROW = 3, 20
# Titles and the gender they tell (fixed values).
TITLES = {
    "Mr": "m", "Mister": "m", "Herr": "m", "Herrn": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Господин": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "Госпожа": "f", "Κυρία": "f",
    "Dr": "n", "Prof": "n",
}
SYLLABLES = {
    "latin": "ba be bi do du fa fe ga go ka ke la le li lo ma me mi na ne no pa ra re ri ro sa se ta te ti to va ve vi za".split(),
    "cyrillic": "ба бе ви га да де зо ка ки ла ле ли ма ми на не но па ра ре ри ро са се та те ти то ва ве за".split(),
    "greek": "βα βε γα δα δε κα κο λα λε λι μα μι να νε νο πα ρα ρε ρι σα σε τα τε τι το".split(),
}
ENDINGS = {
    "latin": {"f": "a", "m": "n", "n": "r"}, "cyrillic": {"f": "а", "m": "н", "n": "р"}, "greek": {"f": "α", "m": "ς", "n": "ρ"},
}
NAME = re.compile(r"[^\W\d_][\w’'-]*")
PARTICLES = "von van vom zu zum zur der den dem ter ten de del della di da dos du la le el al bin ibn y".split()  # these stay
MAIL_NAME = re.compile(r"[\w.%+-]")
MAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
PATTERNS = [
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("phone", re.compile(r"\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])|(?<!\w)\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5}(?!\d)")),
    ("card", re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])")),
    ("ip", re.compile(r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\d]|\.\d)")),
]
DIGIT = re.compile(r"\d")
TITLE = re.compile(rf"(?<!\w)(?:(?:{'|'.join(TITLES)})\.? +)+")
SMALL = re.compile(rf"(?:(?:{'|'.join(PARTICLES)}) +)*")
SPACES = re.compile(" *")
INITIALS = re.compile(r"(?<!\w)(?:[^\W\d_]\. *)+$")


def bare(word: str) -> str:
    """A word without what follows the name: a possessive ending, quotes, hyphens."""
    return re.sub(r"['’]s$", "", word).rstrip("'’-")


def titled(text: str, at: int) -> list[tuple[int, int]]:
    """(start, end) of the capitalised words and initials from here on."""
    words: list[tuple[int, int]] = []
    dotted = False
    while m := NAME.match(text, SMALL.match(text, at).end()):
        start, end = m.start(), m.start() + len(bare(m[0]))
        if not text[start].isupper() or m[0] in TITLES:
            break
        words.append((start, end))
        dotted = end == start + 1 and text[end : end + 1] == "."
        at = SPACES.match(text, end + dotted).end()
        if end < m.end() or at == end:
            break
    if len(words) > 1 and words[-1][1] == words[-1][0] + 1 and not dotted:
        words.pop()  # no initial: "Mr Smith I know"
    return words


def people(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the names behind titles and of the same names elsewhere."""
    found, known = [], {}
    if not any(title in text for title in TITLES):
        return found
    for m in TITLE.finditer(text):
        gender = next((g for t in NAME.findall(m[0]) if (g := TITLES[t]) != "n"), "n")
        words = titled(text, m.end())
        full = [w for w in words if w[1] > w[0] + 1]
        for start, end in words:
            kind = "initial" if end == start + 1 else "family" if (start, end) == full[-1] and (len(full) == 1 or full[-1] == words[-1]) else f"given_{gender}"
            found.append((start, end, kind))
            if kind != "initial":
                known.setdefault(text[start:end].lower(), kind)
    if not known:
        return found
    for m in NAME.finditer(text):
        whole = bare(m[0])
        parts = [(m.start(), whole)]
        if whole.lower() not in known:
            parts = [(m.start() + p.start(), p[0]) for p in re.finditer(r"[^’'-]+", m[0])]
        for start, word in parts:
            if word[:1].isupper() and word.lower() in known:
                found.append((start, start + len(word), known[word.lower()]))
                if start == m.start() and (before := INITIALS.search(text, max(0, start - 16), start)):
                    found += [(i, i + 1, "initial") for i in range(*before.span()) if text[i].isupper()]
    return found


def mails(text: str) -> Iterator[tuple[int, int, str]]:
    """Mail addresses: from each @ back over the name, so that no letter is read twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and MAIL_NAME.match(text[start - 1]):
            start -= 1
        domain = MAIL_DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end(), "email"
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def mentions(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities, leftmost first, none inside another."""
    found = list(mails(text))
    for kind, pattern in PATTERNS if DIGIT.search(text) else ():  # each of them has digits
        found += [(*m.span(), kind) for m in pattern.finditer(text)]
    found += people(text)
    out: list[tuple[int, int, str]] = []
    for start, end, kind in sorted(found, key=lambda x: (x[0], -x[1])):
        if not out or start >= out[-1][1]:
            out.append((start, end, kind))
    return out


def canonical(kind: str, form: str) -> str:
    """The form in which mentions of one entity agree."""
    if kind in ("ssn", "phone", "card"):
        return "".join(c for c in form if c.isdigit())
    return form.lower()


def luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


class Draws:
    """An endless keyed stream of numbers for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, form: str, attempt: int):
        self.key, self.seed, self.block, self.left = key, f"{kind}\0{form}\0{attempt}".encode("utf-8", "surrogatepass"), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        number, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return number % n


def script_of(char: str) -> str:
    name = unicodedata.name(char, "")
    return "cyrillic" if name.startswith("CYRILLIC") else "greek" if name.startswith("GREEK") else "latin"


LETTERS = {"latin": string.ascii_lowercase, "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}


def like(char: str, draws: Draws) -> str:
    """A digit for a digit, a letter of the script for a letter, else the character."""
    if char.isdigit():
        return str(draws.below(10))
    if char.isalpha():
        letters = LETTERS[script_of(char)]
        return letters[draws.below(len(letters))]
    return char


def surrogate(key: bytes, kind: str, form: str, attempt: int, within: str = "") -> str:
    """The surrogate of a canonical form; of a mail address, within its domain's surrogate; of a name, with the gender ``within``."""
    draws = Draws(key, kind, form, attempt)
    if kind == "ip":
        if attempt >= DIGITS_GROW:  # hardly a number of four bytes is free: one of sixteen, from the block for documents
            return "2001:db8:" + ":".join(f"{draws.below(1 << 16):x}" for _ in range(6))
        return ".".join([str(1 + draws.below(223)), *(str(draws.below(256)) for _ in range(3))])
    if kind in ("email", "domain"):
        head, mark, tail = form.rpartition("@" if kind == "email" else ".")
        made = "".join(like(c, draws) for c in head) + "".join(like("a", draws) for _ in range(attempt // LETTERS_GROW))
        return made + mark + (within if kind == "email" else tail)
    if kind == "initial":
        return "".join(like(form[0], draws) for _ in range(1 + attempt // LETTERS_GROW))
    if kind == "name":
        script = script_of(form[0])
        parts = SYLLABLES[script]
        made = "".join(parts[draws.below(len(parts))] for _ in range(2 + draws.below(2) + attempt // LETTERS_GROW))
        return made + ENDINGS[script][within]
    digits = "".join(like(c, draws) for c in form + "0" * (attempt // DIGITS_GROW))
    if kind == "card" and luhn(form) == 0:
        digits = digits[:-1] + str((10 - luhn(digits[:-1] + "0")) % 10)
    return digits


def written(mention: str, kind: str, new: str) -> str:
    """A surrogate in the format of the mention it replaces."""
    if kind in ("ssn", "phone", "card"):
        digits = iter(new)
        return "".join([*(next(digits) if c.isdigit() else c for c in mention), *digits])
    if kind == "email":
        return "".join(n.upper() if m.isupper() else n for m, n in zip(mention, new)) if len(mention) == len(new) else new
    if kind == "ip":
        return new
    return new.upper() if len(mention) > 1 and mention.isupper() else new[0].upper() + new[1:] if mention[0].isupper() else new


MENTION = "array<struct<start:int,end:int,kind:string,form:string>>"


def _split(docs: DataFrame, text: str, found: bool) -> DataFrame:
    """The rows with entities, and these; or the rows without any."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("form", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text):
            spans = [mentions(t) for t in texts]
            chosen = pa.array([bool(s) == found for s in spans])
            if not found:
                yield batch.filter(chosen)
                continue
            rows = [
                [{"start": s, "end": e, "kind": k, "form": canonical(k, t[s:e])} for s, e, k in own] for t, own in zip(texts, spans)
            ]
            yield batch.append_column("__mentions", pa.array(rows, kind)).filter(chosen)

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, shape + (f", __mentions {MENTION}" if found else ""))


def _settle(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, form, surrogate) for distinct (kind, form, within), all different and none an entity."""
    entities = stored(entities, "pii-entities")
    pending, settled = entities.withColumn("attempt", F.lit(0)), []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, forms, withins, attempts = (batch.column(i).to_pylist() for i in range(4))
            made = [surrogate(key, k, f, a, w) for k, f, w, a in zip(kinds, forms, withins, attempts)]
            yield batch.append_column("surrogate", pa.array(made, pa.string()))

    while True:
        proposed = stored(pending.mapInArrow(run, "kind string, form string, within string, attempt int, surrogate string"), "pii-proposed")
        real = entities.select(F.col("kind").alias("rk"), F.col("form").alias("rf"))
        free = proposed.join(real, (F.col("kind") == F.col("rk")) & (F.col("surrogate") == F.col("rf")), "left_anti")
        for earlier in settled:
            free = free.join(earlier.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        first = free.groupBy("kind", "surrogate").agg(F.min("form").alias("form"))
        settled.append(stored(first.select("kind", "form", "surrogate"), "pii-settled"))
        rest = proposed.join(settled[-1].select("kind", "form"), ["kind", "form"], "left_anti")
        pending = rest.select("kind", "form", "within", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            break
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, form, surrogate) for distinct (kind, form, within), all different and none an entity.

    ``within`` is a name's gender.  Mail domains are settled first, with all else, and the addresses within them.
    """
    entities = stored(entities, "pii-found")
    mails = entities.where("kind = 'email'").select("kind", "form", F.substring_index("form", "@", -1).alias("domain"))
    domains = mails.select(F.lit("domain").alias("kind"), F.col("domain").alias("form"), F.lit("").alias("within")).distinct()
    known = _settle(entities.where("kind <> 'email'").unionByName(domains), key)
    hosts = known.where("kind = 'domain'").select(F.col("form").alias("domain"), F.col("surrogate").alias("within"))
    return known.where("kind <> 'domain'").unionByName(_settle(mails.join(hosts, "domain").select("kind", "form", "within"), key))


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """All rows and columns, the text with surrogates, and n_entities and spans of the original."""
    ship(docs.sparkSession)
    docs, back = set_aside(docs.drop(*(c for c in ("n_entities", "spans") if c in docs.columns)))
    touched = stored(_split(docs, text, True).withColumn("__row", F.monotonically_increasing_id()), "pii-touched")
    kind = F.when(F.col("m.kind").rlike("^(given_|family)"), "name").otherwise(F.col("m.kind")).alias("kind")
    places = touched.select("__row", F.posexplode("__mentions").alias("at", "m")).select("__row", "at", kind, "m.form", F.col("m.kind").alias("told"))
    women = F.sum(F.when(F.col("told") == "given_f", 1).when(F.col("told") == "given_m", -1).otherwise(0)).alias("women")
    gender = F.when(F.col("kind") != "name", "").when(F.col("women") > 0, "f").when(F.col("women") < 0, "m").otherwise("n")
    known = surrogates(places.groupBy("kind", "form").agg(women).select("kind", "form", gender.alias("within")), key)
    lists = places.join(known, ["kind", "form"]).groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("at", "surrogate"))).alias("__new"))
    joined = touched.join(lists, "__row").select(*docs.columns, "__mentions", F.col("__new.surrogate").alias("__new"))
    place, width = docs.columns.index(text), len(docs.columns)
    names = [*docs.columns, "n_entities", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text):
            values, spans = [], []
            for value, own, new in zip(texts, batch.column("__mentions").to_pylist(), batch.column("__new").to_pylist()):
                out, done = [], 0
                for m, fresh in zip(own, new):
                    out += [value[done : m["start"]], written(value[m["start"] : m["end"]], m["kind"], fresh)]
                    done = m["end"]
                values.append("".join([*out, value[done:]]))
                spans.append(",".join(f"{m['kind']}:{m['start']}:{m['end']}" for m in own))
            columns = [batch.column(i) for i in range(width)]
            columns[place] = pa.array(values, pa.string())
            counts = [s.count(":") // 2 for s in spans]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(spans, pa.string())], names=names)

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", n_entities long, spans string"
    clean = _split(docs, text, False).withColumns({"n_entities": F.lit(0).cast("long"), "spans": F.lit("")})
    return back(joined.mapInArrow(run, shape).unionByName(clean))
