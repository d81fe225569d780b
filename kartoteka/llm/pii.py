"""Surrogates for personal data.

E-mail addresses, phone numbers, IP addresses, long numbers (cards, accounts), national ids, IBANs and names are
detected in whole texts, once. Each distinct entity (type and canonical form) gets a surrogate from an HMAC under a secret
key: digits for digits, letters of the same script and case for letters, a name of the same gender and script for a
name, with country codes, separators and check digits (cards, IBANs) kept valid as they were. Names are drawn from
lists of names that the detector does not know, then built from syllables with an ending that tells the gender, so
there are always more of them than a corpus holds. A mention is rendered in its own format, so one entity written in two
ways gets one surrogate in two formats, and a name found in a text is replaced wherever the text repeats one of its
words, in capitals or small letters, too, unless it is a word of its own in small letters (coreference). Surrogates are compared over the whole corpus: one that meets another entity's surrogate, or any
original of its type, is drawn again until all are distinct. Only rows with entities are ever shuffled, and only their
distinct entities are compared; mentions of one hot entity are small rows that AQE splits.

A name starts at a title, at a listed given name, or after a word that introduces people (Dear, Signed, ...). Untitled,
unlisted names in running text are not found. Numbers that a word before them names as an invoice or an order, amounts in
groups of thousands and dates are no phones.

Defined cases: null texts stay null; texts without entities, empty ones too, stay as they are; repeated rows get equal
surrogates; overlapping finds go to the type listed first; a very long text is searched whole; an empty table gives an
empty result; all other columns stay, whatever their names, but for `n_chars`, which follows the new text.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartoteka.llm.common import discard, free_names, stored

#: Rounds of the collision loop; the space to draw from grows with the attempt, so few are ever needed.
ROUNDS = 40
DEMO_KEY = b"replace this key in production"

# Titles with the gender they tell, given names and surnames by script and gender.
TITLES = {
    "Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Don": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f",
    "Madame": "f", "Mme": "f", "Mlle": "f", "Señora": "f", "Sra": "f", "Doña": "f", "Dr": "n", "Prof": "n", "Господин": "m", "Госпожа": "f",
}
GIVEN = {
    ("latin", "m"): "James John Robert Michael William David Thomas Peter Paul Daniel Hans Karl Klaus Stefan Jürgen Pierre Jean Louis Antoine Carlos José Juan Miguel Pedro Luis".split(),
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Susan Sarah Karen Anna Emma Julia Ursula Sabine Monika Petra Marie Claire Sophie Camille María Carmen Lucía Ana Isabel Elena".split(),
    ("cyrillic", "m"): "Иван Алексей Дмитрий Сергей Николай Андрей Павел Михаил Александр Владимир Виктор Юрий".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Екатерина Светлана Людмила Галина Юлия".split(),
    ("greek", "m"): "Γιώργος Γιάννης Δημήτρης Κώστας Νίκος Σωκράτης Πέτρος Παύλος Ανδρέας Χρήστος".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Άννα Σοφία Ειρήνη Δήμητρα Αγγελική Βασιλική Ιωάννα".split(),
}
# Names that are drawn and that the detector does not know.
DRAWN = {
    ("latin", "m"): "Alaric Barnaby Caspian Dorian Edmund Fabian Gareth Hector Ignatius Jasper Konrad Leopold Magnus Nestor Orlando Quentin Roland Silas Tristan Valentin".split(),
    ("latin", "f"): "Adelaide Beatrice Cordelia Delphine Eloise Florence Genevieve Henrietta Imogen Josephine Leonora Matilda Ottilie Penelope Rosalind Seraphina Theodora Viola Wilhelmina Zelda".split(),
    ("latin", "n"): "Avery Blair Casey Darcy Ellis Finley Harper Jules Kerry Lane Marlow Nour Quinn Remy Sasha Toni".split(),
    ("cyrillic", "m"): "Аркадий Богдан Вадим Геннадий Демьян Ефим Захар Кирилл Лев Мирон Тихон Фёдор".split(),
    ("cyrillic", "f"): "Агата Вера Дарья Евгения Зинаида Клавдия Лидия Марфа Нина Полина Раиса Таисия".split(),
    ("greek", "m"): "Αχιλλέας Ευριπίδης Θεμιστοκλής Ιάσονας Λεωνίδας Μιλτιάδης Οδυσσέας Περικλής".split(),
    ("greek", "f"): "Αφροδίτη Ευτυχία Θάλεια Καλλιόπη Μυρτώ Ναυσικά Πηνελόπη Χρυσάνθη".split(),
}
SURNAMES = "Smith Johnson Brown Miller Wilson Taylor Clark Walker Müller Schmidt Fischer Weber Wagner Becker Martin Bernard Dubois Moreau Laurent García López Sánchez Torres Navarro".split()
# Syllables, and endings that tell gender and kind.
SYLLABLES = {
    "latin": "ba de fi go lu ma ne ri so ta ve zo ka le mi no".split(), "cyrillic": "ба де фи го лу ма не ри со та ве зо ка ле ми но".split(),
    "greek": "βα δε φι γο λου μα νε ρι σο τα βε ζο κα λε μι νο".split(),
}
ENDINGS = {
    ("given", "latin", "m"): "an er ius olf ard".split(), ("given", "latin", "f"): "a ia ina elle ette".split(), ("given", "latin", "n"): "i ey is en".split(),
    ("given", "cyrillic", "m"): "ан ей ил ор".split(), ("given", "cyrillic", "f"): "а ия ина ела".split(),
    ("given", "greek", "m"): "ος ης ας".split(), ("given", "greek", "f"): "α η ία".split(),
    ("surname", "latin", "n"): "berg feld mann sen ton ard ez ini".split(),
    ("surname", "cyrillic", "m"): "ов ин ский ев".split(), ("surname", "cyrillic", "f"): "ова ина ская ева".split(),
    ("surname", "greek", "m"): "όπουλος ίδης άκης".split(), ("surname", "greek", "f"): "οπούλου ίδου άκη".split(),
}
_VOWELS = "aeiouаеиоуαειου"
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω")

# More given names that are found but never drawn.
MORE_GIVEN = {
    "m": "Adam Alan Albert Alejandro Alexander Andreas Andrew Anthony Mark Arthur Benjamin Bernd Brian Charles Christian Christopher Dennis Diego Donald Edward Eric Felix Fernando Florian Frank François Frédéric Gary George Georg Günter Harry Heinz Helmut Henri Henry Jack Jacques Javier Jason Jeffrey Jörg Jorge Joseph Joshua Julien Jürgen Kenneth Kevin Lars Laurent Lukas Luke Manuel Markus Martin Matthew Matthias Max Michel Nicolas Oliver Olivier Oscar Pablo Patrick Philippe Rafael Ralf Raymond Ricardo Richard Roger Ronald Ryan Samuel Scott Sebastian Sergio Simon Stephen Steven Sven Thierry Timothy Tobias Tom Uwe Walter Wolfgang Ahmed Ali Arjun Giovanni Hassan Hiroshi Ibrahim Ivan Jakub Kenji Luca Marco Marko Matteo Mohammed Omar Piotr Rajesh Takashi Tomasz Wei".split(),
    "f": "Alice Amanda Amy Andrea Angela Angelika Anne Barbara Beatriz Betty Birgit Brigitte Carol Catherine Charlotte Christine Claudia Cristina Daniela Deborah Diana Donna Dorothy Elisabeth Emily Eva Françoise Gabriele Grace Hannah Heike Helen Helga Inès Isabelle Jane Janet Jessica Joan Juliette Karin Katharina Katrin Kimberly Laura Lauren Lena Lisa Lucy Manon Margaret Maria Marta Martina Martine Melissa Michelle Mónica Nadine Nancy Nathalie Nicole Nina Olivia Pamela Patricia Paula Pilar Rachel Rebecca Renate Rosa Ruth Sandra Sara Sharon Silvia Sofía Stephanie Susanne Sylvie Teresa Ute Valérie Véronique Victoria Virginia Agnieszka Aisha Anjali Chiara Fatima Francesca Giulia Ivana Katarzyna Leila Mariana Nadia Priya Sakura Yuki Zofia".split(),
}

# Names that are words of their own in small letters.
WORDS = {*"brown miller walker baker taylor smith cook young king rose may will mark grace hope weber fischer becker wagner martin jack bill rich sue art frank pat".split()}
# Words that introduce people, and words that end or are no part of a name.
CUES = {*"dear sincerely regards signed contact attn attention author liebe lieber grüße geehrte geehrter cher chère cordialement querido querida estimado estimada atentamente уважаемый уважаемая αγαπητέ αγαπητή".split()}
STOP = {
    *"And The Or Of In On At To For From By With But If When Then That This He She It They We You I His Her Their Our My Is Was Are Were Und Der Die Das Ein Eine Oder Aber Wenn Et Le La Les Un Une Des Du De Ou Mais Si Il Elle".split(),
    *"Y El Los Las Una O Pero City Council University Street Road House Company Bank Times Team Sir Madam Customer Customers Colleagues Friends Inc Ltd GmbH AG И В На Но Или Και Ο Η Το".split(),
}
_UP = "A-ZÀ-ÖØ-ÞΑ-ΩΆΈ-ΊΌΎΏА-ЯЁ"
EMAIL = re.compile(r"[\w%+-][\w.%+-]*@[\w-]+(?:\.[\w-]+)+")
IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
IPV4 = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)")
IPV6 = re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f:]*:[0-9A-Fa-f]*:)[0-9A-Fa-f:]{3,39}(?![\w:])")
NATIONAL = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
CARD = re.compile(r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])")
# The digit count decides, see `_is_phone`: international numbers, those after a trunk 0, blocks of 2 to 4 digits, local 3-4 ones.
PHONE = re.compile(
    r"(?<![\w.+])\+\d{1,4}(?:[ ./-]{0,2}(?:\(\d{1,5}\)|\d{1,8})){1,7}(?!\w|[.]\d)"
    r"|(?<![\w.+,/-])(?:\(0\d{1,5}\)|0\d{1,8})(?:(?: ?/ ?|[ .-]{1,2})\d{1,8}){1,6}(?!\w|[.,]\d)"
    r"|(?P<local>(?<![\w.,+$€£/()-])\d{3}-\d{4}(?![\w/-]|[.,]\d))"
    r"|(?<![\w.])(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,4}(?!\w|[.]\d)"
    r"|(?<![\w.+])\+?\d{9,12}(?!\w)"
)
# What a number is that follows these words, and what is counted by one.
_LABEL = re.compile(r"(?i)(?:invoice|order|ticket|case|ref|reference|isbn|serial|sku|article|rechnung|bestellung|facture|commande|factura|pedido)(?: (?:no|nr|number|id|nummer|n))?[.:#°]{0,2} ?#?$")
_MONEY = re.compile(r"(?i)(?:price|cost|costs|total|sum|amount|preis|summe|prix|somme|precio|suma|[$€£])[: ]{0,2}$")
_UNITS = re.compile(r"(?i) ?(?:units|pieces|people|euros?|eur|usd|dollars|stück|einheiten|personnes|unidades|personas|[€$£])\b")
_THOUSANDS = re.compile(r"\d{1,3}([ .])\d{3}(?:\1\d{3})*")
_DATE = re.compile(r"(?<!\d)(?:\d{1,2}[./-]\d{1,2}[./-](?:19|20)\d\d|(?:19|20)\d\d[./-]\d{1,2}[./-]\d{1,2})(?!\d)")
_TITLED = "|".join(sorted(TITLES, key=len, reverse=True))
NAME = re.compile(rf"(?<!\w)[{_UP}][\w'’-]*\.?(?: (?:(?:[{_UP}]|{_TITLED})\.(?= )|[{_UP}][\w'’-]*))+")
_NUMBERS = re.compile(r"\d[\d ()./-]{5,}\d")
_GENDER = {n: ("latin", g) for g, names in MORE_GIVEN.items() for n in names} | {n: (script, g) for (script, g), names in GIVEN.items() for n in names}
# Country codes of two digits.
_TWO = {*"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}


def script_of(word: str) -> str:
    return next((n for n, lo, hi in (("cyrillic", "Ѐ", "ӿ"), ("greek", "Ͱ", "Ͽ"), ("greek", "ἀ", "῾")) if any(lo <= c <= hi for c in word)), "latin")


def surname_kind(word: str) -> str:
    """Surnames tell gender where their script's languages inflect them."""
    script, low = script_of(word), word.casefold()
    if script == "cyrillic":
        return f"surname:{'f' if low[-1:] in 'ая' else 'm'}:cyrillic"
    if script == "greek":
        return f"surname:{'m' if low[-1:] in 'σς' else 'f'}:greek"
    return "surname:n:latin"


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _luhn(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def _names(text: str):
    """(start, end, kind, canonical form) of each word of a name: given names by gender, surnames. A name starts at any title or given name of a run of
    capitalised words, or at the run's start after a cue. Later mentions of a found word count, too."""
    found: dict[str, tuple[str, str]] = {}
    spans = []
    for m in NAME.finditer(text):
        at, gender, known, title = m.start(), None, False, None
        run = m[0].split(" ")
        if run[0].casefold() in CUES:
            cue, first = True, 1
        else:
            before = text[max(0, at - 24) : at].rstrip(" ,:\n").rsplit(None, 1)
            cue, first = bool(before) and before[-1].casefold() in CUES, 0
        cue = cue and len(run) - first >= 2 and not any(w.rstrip(".") in STOP or w.rstrip(".") in TITLES for w in run[first : first + 3])
        for k, w in enumerate(run):
            bare = w.rstrip(".")
            listed = _GENDER.get(bare) or _GENDER.get(bare.title() if bare.isupper() else bare)
            more = k + 1 < len(run) and run[k + 1].rstrip(".") not in STOP
            kind = None
            if bare in TITLES:
                gender = TITLES[bare] if TITLES[bare] != "n" or not known else gender
                known, title = True, k
            elif bare in STOP:
                known = False
            elif listed and (not known or title == k - 1 or run[k - 1] in _GENDER):
                kind, known = f"given:{listed[1]}:{script_of(bare)}", True
            elif known and len(bare) > 1:
                # title, unlisted given name, surname
                kind = f"given:{gender}:{script_of(bare)}" if more and title == k - 1 and gender in ("m", "f") else surname_kind(bare)
            elif cue and k == first and len(bare) > 1:
                script = script_of(bare)
                kind, known = f"given:{'n' if script == 'latin' else 'f' if bare[-1] in 'аяαη' else 'm'}:{script}", True
            if kind:
                found.setdefault(bare, (kind, bare.casefold()))
                spans.append((at, at + len(bare), *found[bare]))
            at += len(w) + 1
    yield from spans
    again = [w for w in found if len(w) > 2]
    if again:
        seen = {x[0] for x in spans}
        forms = {f: w for w in again for f in (w.lower(), w.upper()) if f == w.upper() or f not in WORDS} | {w: w for w in again}
        for m in re.finditer(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(forms, key=len, reverse=True)))})(?!\w)", text):
            if m.start() not in seen:
                yield m.start(), m.end(), *found[forms[m[0]]]


def _is_phone(m: re.Match, text: str) -> bool:
    before = text[max(0, m.start() - 24) : m.start()]
    if m[0][0] not in "+0(" and (_LABEL.search(before) or re.match(r"(?:19|20)\d\d-\d{4}-\d{4}$", m[0])):
        return False
    if _THOUSANDS.fullmatch(m[0]) and (m[0].endswith("000") or _MONEY.search(before) or _UNITS.match(text, m.end())):
        return False
    return m.lastgroup == "local" or (8 if m[0][0] == "+" else 9) <= len(_digits(m[0])) <= 15


def _is_ipv6(text: str) -> bool:
    try:
        return int(ipaddress.IPv6Address(text)) > 1
    except ValueError:
        return False


def _canonical(kind: str, text: str) -> str:
    if kind == "email":
        return text.casefold()
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "ip":
        return text
    if kind == "ipv6":
        return ipaddress.IPv6Address(text).exploded
    digits = _digits(text)
    return digits[1:] if kind == "phone" and len(digits) == 11 and digits[0] == "1" else digits


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) in code points, without overlaps."""
    if not text:
        return []
    found: list[tuple[int, int, str, str]] = []  # sorted, without overlaps

    def put(start: int, end: int, kind: str, canon: str) -> None:
        at = bisect_left(found, (start,))
        if (at == len(found) or end <= found[at][0]) and (at == 0 or found[at - 1][1] <= start):
            insort(found, (start, end, kind, canon))

    kinds = [("email", EMAIL)] if "@" in text else []
    if _NUMBERS.search(text):
        kinds += [("iban", IBAN), ("ip", IPV4), ("national", NATIONAL), ("card", CARD), ("phone", PHONE)]
    if "::" in text or text.count(":") > 6:
        for m in IPV6.finditer(text):
            if _is_ipv6(m[0]):
                put(*m.span(), "ipv6", _canonical("ipv6", m[0]))
    for kind, pattern in kinds:
        # Dates are no phones, but phones may stand beside them.
        for m in pattern.finditer(_DATE.sub(lambda d: "x" * len(d[0]), text) if kind == "phone" else text):
            if kind != "phone" or _is_phone(m, text):
                put(*m.span(), kind, _canonical(kind, m[0]))
    for name in _names(text):
        put(*name)
    return found


class _Stream:
    """Numbers from an HMAC in counter mode."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.seed, self.block, self.pool = key, "\x1f".join(parts), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool += hmac.new(self.key, f"{self.seed}\x1f{self.block}".encode(), hashlib.sha256).digest()
            self.block += 1
        x, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return x % n


def _letter(c: str, draw: _Stream) -> str:
    if c.isdigit():
        return str(draw.below(10))
    if not c.isalpha():
        return c
    letters = next((a for a in ALPHABETS if c.lower() in a), ALPHABETS[0])
    out = letters[draw.below(len(letters))]
    return out.upper() if c.isupper() else out


def _mod97(text: str) -> int:
    """The remainder of an IBAN's digits, letters read as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _new_name(role: str, gender: str, script: str, draw: _Stream, attempt: int) -> str:
    """A listed name first, then syllables and an ending of the same role, gender and script; the space grows with the attempt."""
    listed = DRAWN[script, gender] if role == "given" else SURNAMES if script == "latin" else []
    if attempt < 2 and listed:
        return listed[draw.below(len(listed))].casefold()
    stem = "".join(SYLLABLES[script][draw.below(16)] for _ in range(2 + attempt // 6))
    endings = ENDINGS[role, script, gender]
    end = endings[draw.below(len(endings))]
    return (stem.rstrip(_VOWELS) if end[0] in _VOWELS + "ίόά" else stem) + end


def surrogate(kind: str, canon: str, attempt: int, key: bytes = DEMO_KEY) -> str:
    """The canonical form of the replacement."""
    draw = _Stream(key, kind, canon, str(attempt))
    if kind.startswith(("given", "surname")):
        return _new_name(*kind.split(":"), draw, attempt)
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "ipv6":  # empty groups stay empty, others as long as they are
        sizes = [len(g.lstrip("0")) for g in canon.split(":")]
        return ":".join(f"{16 ** (n - 1) + draw.below(15 * 16 ** (n - 1)):04x}" if n else "0000" for n in sizes)
    if kind == "email":
        local, _, domain = canon.partition("@")
        host, _, top = domain.rpartition(".")
        site = _Stream(key, "domain", domain, str(attempt // 6))  # one domain stays one domain
        more = "".join(chr(97 + draw.below(26)) for _ in range(attempt // 3))
        return "".join(_letter(c, draw) for c in local) + more + "@" + "".join(_letter(c, site) for c in host) + "." + top
    if kind == "iban":
        body = "".join(_letter(c, draw) for c in canon[4:])
        good = f"{98 - _mod97(body + canon[:2] + '00'):02d}"
        return canon[:2] + (good if _mod97(canon[4:] + canon[:4]) == 1 else f"{(int(good) + 1 + draw.below(90)) % 100:02d}") + body
    kept = canon[:-10] if kind == "phone" and len(canon) > 10 else ""  # country code
    if kind == "phone" and len(canon) == 11 and canon[:2] in _TWO:
        kept = canon[:2]
    body = "".join(str(draw.below(10)) for _ in canon[len(kept) :])
    if kind == "phone" and canon[len(kept)] != "0":
        body = str(2 + draw.below(8)) + body[1:]
    out = kept + body
    if kind == "card":  # valid check digits stay valid, others invalid
        out = next(c for c in (out[:-1] + str((int(out[-1]) + i) % 10) for i in range(10)) if _luhn(c) == _luhn(canon))
    return out


def render(kind: str, original: str, canon: str) -> str:
    """The surrogate in the format of this mention."""
    if kind.startswith(("given", "surname")):
        return canon.upper() if original.isupper() and len(original) > 1 else canon.title() if original[:1].isupper() else canon
    if kind == "email":
        own = [c for c in original]
        return "".join(x.upper() if i < len(own) and own[i].isupper() else x for i, x in enumerate(canon))
    if kind == "ip":
        return canon
    if kind == "ipv6":
        new = ipaddress.IPv6Address(canon)
        out = new.exploded if len(original) == 39 else new.compressed if "::" in original else ":".join(f"{int(g, 16):x}" for g in new.exploded.split(":"))
        return out.upper() if original.isupper() else out
    fill = iter(canon if kind == "iban" else _digits(original)[: len(_digits(original)) - len(canon)] + canon)
    return "".join(next(fill) if (c.isalnum() if kind == "iban" else c.isdigit()) else c for c in original)


MENTIONS = "array<struct<start:int,end:int,kind:string,canon:string>>"


def _find(batches):
    """Rows with their entities in `_found`, null where there are none."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("canon", pa.string())]))
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            found = [[dict(zip(("start", "end", "kind", "canon"), x, strict=True)) for x in detect(t)] or None for t in part.column("_text").to_pylist()]
            out = part.drop_columns(["_text"])
            yield pa.record_batch([*out.columns, pa.array(found, kind)], [*out.schema.names, "_found"])


def resolve(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, canon, surrogate) with distinct surrogates that are no original of their kind."""

    def draw(batches):
        for batch in batches:
            own = [surrogate(k, c, a, key) for k, c, a in zip(*(batch.column(x).to_pylist() for x in ("kind", "canon", "attempt")), strict=True)]
            yield pa.record_batch([batch.column("kind"), batch.column("canon"), batch.column("attempt"), pa.array(own, pa.string())], ["kind", "canon", "attempt", "surrogate"])

    schema = "kind string, canon string, attempt int, surrogate string"
    originals = entities.select("kind", F.col("canon").alias("surrogate")).withColumn("real", F.lit(True))
    todo, before = entities.withColumn("attempt", F.lit(0)), None
    for _ in range(ROUNDS):
        drawn = stored(todo.mapInArrow(draw, schema), "surrogates")
        # Who came to a surrogate in an earlier round keeps it.
        best = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "canon")).alias("best"))
        judged = drawn.join(best, ["kind", "surrogate"]).join(originals, ["kind", "surrogate"], "left")
        judged = judged.withColumn("lost", (F.col("best.canon") != F.col("canon")) | F.col("real").isNotNull())
        todo = judged.select("kind", "canon", (F.col("attempt") + F.col("lost").cast("int")).alias("attempt"))
        done = judged.filter("lost").isEmpty()
        if before is not None:
            discard(before)
        before = drawn
        if done:
            return drawn.select("kind", "canon", "surrogate")
    raise RuntimeError(f"surrogates still collide after {ROUNDS} rounds")


def replace(docs: DataFrame, key: bytes = DEMO_KEY, counted: bool = True) -> DataFrame:
    """All rows and columns of docs, entities replaced, and if `counted` a last column n_entities (long)."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    own = docs.toDF(*names)
    text = names[docs.columns.index("text")]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema)
    # Texts are searched once and written with what was found.
    searched = own.withColumn("_text", F.col(text)).mapInArrow(_find, f"{fields}, _found {MENTIONS}").withColumn("_rid", F.monotonically_increasing_id())
    rows = stored(searched, "mentions", codec="zstd")
    hits, rest = rows.filter("_found is not null"), rows.filter("_found is null").select(*names, F.lit(0).cast("long").alias("_n"))
    mentions = hits.select("_rid", F.explode("_found").alias("m")).select("_rid", "m.*")
    found = resolve(stored(mentions.select("kind", "canon").distinct(), "entities"), key)
    new = mentions.join(found, ["kind", "canon"]).groupBy("_rid").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind", "surrogate"))).alias("_new"))

    def apply(batches):
        for batch in batches:
            out = []
            for t, spans in zip(batch.column(text).to_pylist(), batch.column("_new").to_pylist(), strict=True):
                at, parts = 0, []
                for s in spans:
                    parts += [t[at : s["start"]], render(s["kind"], t[s["start"] : s["end"]], s["surrogate"])]
                    at = s["end"]
                out.append("".join([*parts, t[at:]]))
            yield pa.record_batch([pa.array(out, pa.string()) if n == text else batch.column(n) for n in (*names, "_n")], [*names, "_n"])

    joined = hits.drop("_found").join(new, "_rid").withColumn("_n", F.size("_new").cast("long")).drop("_rid")
    both = joined.mapInArrow(apply, f"{fields}, _n long").unionByName(rest)
    chars: Column = F.when(F.col("_n") > 0, F.length(text)).otherwise(F.col(names[docs.columns.index("n_chars")])) if "n_chars" in docs.columns else F.lit(None)
    cols = [chars.cast(f.dataType).alias(n) if f.name == "n_chars" else F.col(n) for n, f in zip(names, docs.schema, strict=True)]
    return both.select(*cols, "_n").toDF(*docs.columns, *free_names(["n_entities"], docs.columns)) if counted else both.select(*cols).toDF(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    return replace(docs.select("doc_id", "text", "lang", "source", "n_chars"))
