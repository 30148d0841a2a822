"""Personal data replaced by surrogates of the same type, format, script and gender.

Entities are found by pattern and checksum (e-mail addresses, phone numbers, IP
addresses, payment cards, social security numbers, IBANs) and by title or listed given
name, and then wherever the text has that name again (persons; given and family names are entities of their own, so "Maria
Lopez" and a later "Mrs Lopez" stay the same person). A surrogate is drawn
from a keyed hash of the entity, so the same entity gets the same surrogate in
every document of a run, and without the key none can be traced back. Another run with
other documents may draw others, as draws are checked against the entities there and a name's
gender is that of most of its mentions.

Draws are checked against each other and against all entities found: no two
entities share a surrogate, and no surrogate is an entity that occurs. An
entity whose draw is taken draws again; of several that drew the same
the one of the smallest hash has it. The check is a join over the distinct
entities, which never leave the executors.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import ipaddress
import itertools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.scratch import cut, row_hash
from tidepool.llm.textio import parts, utf8

KINDS = ("email", "iban", "card", "ssn", "ip", "phone", "name")
#: Draws after which the format is left for a larger space: phones, cards and e-mail names get longer, social security numbers and
#: IBANs take letters for digits, IPv4 addresses become ones of the documentation range of IPv6. So the draws always come to an end.
GROW = 6

# Titles and given names by gender, most common first.
TITLES = {"Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "господин": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "госпожа": "f",
          "Dr": "n", "Prof": "n", "Professor": "n"}
GIVEN = {
    ("latin", "m"): """James Robert John Michael David William Richard Joseph Thomas Charles Daniel Matthew Peter Andreas Stefan Jürgen Pierre François Carlos José
        Christopher Anthony Mark Donald Steven Andrew Paul Joshua Kenneth Kevin Brian George Timothy Ronald Edward Jason Jeffrey Ryan Jacob Gary Nicholas Eric Jonathan
        Stephen Larry Justin Scott Brandon Benjamin Samuel Gregory Alexander Patrick Frank Raymond Jack Dennis Jerry Tyler Aaron Henry Adam Douglas Nathan Zachary Kyle
        Walter Harold Jeremy Ethan Carl Keith Roger Gerald Lawrence Sean Christian Albert Arthur Ralph Bryan Philip Eugene Vincent Russell Louis Oliver Simon Martin
        Hans Klaus Wolfgang Jörg Günter Günther Uwe Dieter Manfred Heinrich Friedrich Matthias Markus Sebastian Florian Lukas Felix Björn Sven Lars Erik Nils
        Jean Jacques Michel Philippe Alain Bernard Nicolas Laurent Julien Olivier Frédéric Étienne Émile André René Gérard Guillaume Mathieu Antoine
        Juan Antonio Manuel Francisco Luis Javier Miguel Ángel Pedro Pablo Jorge Fernando Diego Alejandro Sergio Rafael Andrés Raúl Álvaro Óscar Jesús Ramón Enrique
        Giovanni Giuseppe Marco Luca Paolo Francesco Roberto Alessandro Matteo João Paulo Tiago Mohammed Muhammad Ahmed Ali Omar Hassan Ibrahim Raj Amit Rahul Vijay
        Wei Jan Piotr Krzysztof Andrzej Tomasz Ivan Dmitry Sergei Vladimir Hiroshi Kenji Tariq Imran Yusuf Mustafa Mehmet Kwame Chinedu Oluwaseun Arjun Sanjay Minh Ciarán""".split(),
    ("latin", "f"): """Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Sabine Ursula Katharina Françoise Camille Carmen María Lucía
        Maria Lisa Betty Sandra Ashley Kimberly Emily Donna Michelle Carol Amanda Melissa Deborah Stephanie Rebecca Sharon Laura Cynthia Dorothy Amy Kathleen Angela
        Shirley Emma Brenda Pamela Nicole Anna Samantha Katherine Christine Helen Debra Rachel Carolyn Janet Catherine Heather Diane Olivia Julie Joyce Victoria Ruth
        Virginia Lauren Kelly Christina Joan Evelyn Judith Andrea Hannah Megan Cheryl Jacqueline Martha Madison Teresa Gloria Sara Janice Ann Anne Kathryn Abigail Sophia
        Frances Alice Judy Isabella Julia Grace Amber Denise Danielle Marilyn Beverly Charlotte Natalie Theresa Diana Brittany Doris Kayla Alexis Lori Marie Sophie
        Claudia Monika Petra Gabriele Birgit Heike Renate Ingrid Helga Anja Silke Kerstin Greta Jutta Käthe Zoë Chloé Léa Manon Élise Émilie Hélène Céline Amélie Aurélie
        Isabelle Nathalie Sylvie Valérie Monique Brigitte Jeanne Pilar Dolores Isabel Ana Cristina Marta Elena Rosa Raquel Sofía Beatriz Inés Mónica Verónica Ángela
        Giulia Chiara Francesca Paola Fatima Aisha Leila Priya Anjali Mei Yuki Agnieszka Katarzyna Małgorzata Olga Tatiana Svetlana Natalia Irina Siobhan Niamh Ayesha Zainab Ngozi Adaeze Priyanka Deepika Lakshmi Ayşe Elif Sakura""".split(),
    ("cyrillic", "m"): """Александр Дмитрий Сергей Андрей Михаил Николай Владимир Павел Алексей Иван Максим Евгений Виктор Юрий Олег Игорь Пётр Петр Артём Артем Константин Борис
        Василий Григорий Роман Денис Антон Кирилл Илья Фёдор Федор Анатолий Валерий Вячеслав""".split(),
    ("cyrillic", "f"): """Анна Мария Елена Ольга Татьяна Наталья Ирина Светлана Екатерина Юлия Людмила Галина Марина Надежда Анастасия Виктория Дарья Ксения Нина Любовь Вера
        Алина Полина Валентина Лариса Оксана София Александра""".split(),
    ("greek", "m"): "Γιώργος Δημήτρης Κώστας Νίκος Παναγιώτης Γιάννης Βασίλης Χρήστος Μιχάλης Ανδρέας Αλέξανδρος Θανάσης Σπύρος Σταύρος Πέτρος".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Βασιλική Σοφία Αικατερίνη Αγγελική Γεωργία Δήμητρα Άννα Ιωάννα Ευαγγελία Κωνσταντίνα Χριστίνα Όλγα".split(),
}
_SYLLABLES = {"latin": "ba be bo da del dor fa fen gar ha kel la len lo mar mi nor pa per ra ro sa sel ta tor va wen zan".split(),
              "cyrillic": "ба бе бор ва вел дан дор ка кор ла лен ма мир на нор ра рос са сел та тор".split(),
              "greek": "βα βε γα δα δο κα κο λα λε μα μι να νο πα ρα ρο σα τα το".split()}
_ENDING = {("latin", "m"): "n", ("latin", "f"): "a", ("latin", "n"): "s", ("cyrillic", "m"): "н", ("cyrillic", "f"): "на", ("cyrillic", "n"): "к",
           ("greek", "m"): "ς", ("greek", "f"): "α", ("greek", "n"): "ου"}
_FAMILY_ENDING = {"cyrillic": {"m": "ов", "f": "ова", "n": "ко"}, "greek": {"m": "ίδης", "f": "ίδου", "n": "άκης"}}
# Small words between a given and a family name; capitalised words that end a run of name words.
_PARTICLES = frozenset("von van der den de la las los del della di da dos das du le el al bin ibn ter ten zu zum zur af av".split())
_STOP = frozenset("""the and or but if of in on at to by for from with as is are was were be has have had will would can could should may might must do does did not no
    he she it we they you his her its their our my your this that these those there here then than when while where who what which how why after before since until
    also however although because so yet both either und oder aber der die das ein eine ist war hat wird mit für von zu im am den dem des er sie wir ihr es nicht
    et ou mais le les un une des est était avec pour dans sur il elle nous vous ils elles y o pero el los las una es era con para en se su que
    и или но он она мы вы они не что как это в на с к по за και ή αλλά ο η το οι τα δεν που""".split())
_GENDER_OF = {name.casefold(): gender for (_, gender), names in GIVEN.items() for name in names}

_NUMBER = re.compile(r"\d[\d(). -]{4,}", re.ASCII)  # none of the number patterns matches without
_DOMAIN = re.compile(r"@((?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24})")
_LOCAL = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?\Z")
_IP = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)", re.ASCII)
_CARD = re.compile(r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])", re.ASCII)
_SSN = re.compile(r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])", re.ASCII)
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\)[ ]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])", re.ASCII)
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)", re.ASCII)
_NANP = re.compile(r"(?<![\w+.-])(?<!\d[ (])(?:[2-9]\d{2} [2-9]\d{2} \d{4}|[2-9]\d{2}[2-9]\d{6}|0[1-9]\d{0,3}[ -]\d{3,4}[ -]\d{3,4}|0[1-9]\d{8,9})(?![\w-]|\.\d| \d)", re.ASCII)
_IP6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}:[0-9A-Fa-f:]*:[0-9A-Fa-f.]*(?!\w|:)", re.ASCII)
_LETTERS = re.compile(r"[^\W\d_]+")
_WORD = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*")
_INITIALS = re.compile(r"(?:[^\W\d_]\.[ ]?)*[^\W\d_](?:\.|(?!\w))")
_GAP = re.compile(r"[^\S\r\n]*(?:\r?\n)?[^\S\r\n]*")


# -- finding --------------------------------------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def script_of(word: str) -> str:
    name = unicodedata.name(word[0], "")
    return "cyrillic" if name.startswith("CYRILLIC") else "greek" if name.startswith("GREEK") else "latin"


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical) of the entities of a text, in order, none overlapping.

    Of overlapping candidates the kind listed first in KINDS has it. The
    canonical form of a name is ``given`` or ``family``, script, gender and the name; the
    gender is what this mention shows, see ``settle_genders``.
    """
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            local = _LOCAL.search(text, max(0, m.start() - 64), m.start())
            if local:
                found.append((local.start(), m.end(), "email", text[local.start(): m.end()].lower()))
    if text.count(":") > 1:
        found += [(*m.span(), "ip", str(a)) for m in _IP6.finditer(text) if (a := _ip6(m[0]))]
    if _NUMBER.search(text):
        found += _numbers(text)
    found += _names(text)
    taken, out = bytearray(len(text)) if found else bytearray(), []
    for s in sorted(found, key=lambda s: KINDS.index(s[2])):
        if not any(taken[s[0]: s[1]]):
            taken[s[0]: s[1]] = b"\1" * (s[1] - s[0])
            out.append(s)
    return sorted(out)


def _numbers(text: str) -> list[tuple[int, int, str, str]]:
    found: list[tuple[int, int, str, str]] = []
    for m in _IBAN.finditer(text):
        flat = m[0].replace(" ", "")
        if 15 <= len(flat) <= 34 and _mod97(flat) == 1:
            found.append((*m.span(), "iban", flat))
    for m in _CARD.finditer(text):
        digits = re.sub(r"\D", "", m[0])
        if luhn(digits) and len(set(digits)) > 1:
            found.append((*m.span(), "card", digits))
    found += [(*m.span(), "ssn", m[0].replace("-", "")) for m in _SSN.finditer(text)]
    for m in _IP.finditer(text):
        octets = [int(x) for x in m[0].split(".")]
        if max(octets) < 256:
            found.append((*m.span(), "ip", ".".join(map(str, octets))))
    for m in _PHONE.finditer(text):
        digits = re.sub(r"[^\d+]", "", m[0])
        if 8 <= len(digits.lstrip("+")) <= 15:
            found.append((*m.span(), "phone", digits))
    for m in _NANP.finditer(text):
        digits = re.sub(r"\D", "", m[0])
        if 9 <= len(digits) <= 11 and len(set(digits)) > 2:
            found.append((*m.span(), "phone", digits))
    return found


def _ip6(part: str) -> ipaddress.IPv6Address | None:
    """The address that ``part`` is; scopes of programs (a::b) and the addresses of no host are none."""
    try:
        a = ipaddress.IPv6Address(part)
    except ValueError:
        return None
    groups = [g for g in part.split(":") if g]
    return a if len(groups) > 2 or len(groups) == 2 and any(c.isdigit() for c in part) else None


_TITLE_OF = {t.casefold(): gender for t, gender in TITLES.items()}
_LEADS = frozenset(_TITLE_OF) | frozenset(_GENDER_OF)


def _names(text: str) -> list[tuple[int, int, str, str]]:
    """Persons: the run of name words behind a title or from a listed given name on, and later bare mentions of them."""
    if _LEADS.isdisjoint(map(str.casefold, set(_LETTERS.findall(text)))):
        return []
    found: dict[int, tuple[int, int, str, str]] = {}
    at = 0
    for m in _LETTERS.finditer(text):
        low = m[0].casefold()
        if m.start() < at or low not in _LEADS or m.start() and (text[m.start() - 1].isalnum() or text[m.start() - 1] == "_"):
            continue
        if low in _TITLE_OF:
            start = m.end() + text.startswith(".", m.end())
            gap = _GAP.match(text, start).end()
            if gap == start or low == "ms" and not m[0][0].isupper() and text[: m.start()].rstrip()[-1:].isdigit():
                continue
            run = _run(text, gap, titled=True)
            # MS Windows: a title in capitals goes with a name in capitals
            if run and not (m[0].isupper() and len(m[0]) > 1 and not all(text[i:j].isupper() for i, j in run["words"])):
                at = _add(found, text, run, _TITLE_OF[low])
        elif m[0][0].isupper():
            run = _run(text, m.start())
            if run and len(run["words"]) > 1:
                at = _add(found, text, run, _GENDER_OF[low])
    if found:
        _add_bare(found, text)
    return list(found.values())


def _run(text: str, at: int, titled: bool = False) -> dict | None:
    """Name words and initials from ``at`` on. A line break is crossed only while given names and initials came."""
    words: list[tuple[int, int]] = []
    spans: list[list[int]] = []  # of the words with the initials that go with them
    held = None  # where initials without a word before them begin
    particles, given, first = 0, True, True
    while True:
        start = at
        if not first:
            at = _GAP.match(text, start).end()
            if at == start or not given and ("\n" in text[start:at]):
                break
        first = False
        m = _INITIALS.match(text, at)
        if m and all(c.isupper() for c in m[0] if c.isalpha()) and (m[0].endswith(".") or m[0] not in ("I", "A", "O", "Y")) and not particles:
            if spans:
                # an initial that ends a sentence is not followed by a name
                nxt = _WORD.match(text, _GAP.match(text, m.end()).end())
                if not nxt or not nxt[0][0].isupper() or nxt[0].casefold() in _STOP:
                    break
                spans[-1][1] = m.end()
                given = True
            elif held is None:
                held = at
            at = m.end()
            continue
        m = _WORD.match(text, at)
        if not m:
            break
        end = m.end() - 2 if m[0][-2:] in ("'s", "’s") else m.end()
        word = text[at:end]
        low = word.casefold()
        if word in _PARTICLES and particles < 3 and given:
            particles += 1
            at = m.end()
            continue
        if not word[0].isupper() or len(word) < 2 or low in _STOP or low in _TITLE_OF or low in _NO_PERSON and not titled:
            if low in _NO_PERSON and words and word[0].isupper():
                return None  # what the noun names has the words before it in its name
            break
        words.append((at, end))
        spans.append([at if held is None else held, end])
        held, particles, given = None, 0, low in _GENDER_OF
        at = m.end()
        if end < m.end():
            break
    return {"words": words, "spans": spans, "end": spans[-1][1]} if words else None


def _add(found: dict, text: str, run: dict, gender: str) -> int:
    """The words of a run as entities, the last as the family name; returns where the run ends."""
    last = len(run["words"]) - 1
    for k, ((i, j), (a, b)) in enumerate(zip(run["words"], run["spans"])):
        low = text[i:j].casefold()
        if k < last:
            gender = _GENDER_OF.get(low, gender) if k == 0 else gender
            found[a] = (a, b, "name", f"given {script_of(low)} {_GENDER_OF.get(low, gender)} {low}")
        else:
            found[a] = (a, b, "name", f"family {script_of(low)} {_family_gender(low, gender)} {low}")
    return run["end"]


def _add_bare(found: dict, text: str) -> None:
    """Mentions of the names found without title or given name, capitalised as names are."""
    known: dict[str, str] = {}
    taken = sorted(s[:2] for s in found.values())
    for _, _, _, canonical in sorted(found.values()):
        part, _, _, low = canonical.split(" ", 3)
        if low not in known or part == "family":
            known[low] = canonical
    k = 0
    for m in _WORD.finditer(text):
        pieces = [m.span()] if m[0].casefold() in known else [p.span() for p in _LETTERS.finditer(text, *m.span())] if not m[0].isalpha() else []
        for i, j in pieces:
            while k < len(taken) and taken[k][1] <= i:
                k += 1
            low = text[i:j].casefold()
            if low in known and text[i].isupper() and (m.span() != (i, j) or not _ARTICLE.search(text, max(0, i - 12), i)) and not _named_after(text, j) and not (k < len(taken) and taken[k][0] < j) and not (i and text[i - 1] in "_0123456789"):
                found[i] = (i, j, "name", known[low])


#: Nouns that end names of places, bodies and things; a capitalised run without a title that has one of them is no person.
_NO_PERSON = frozenset("""university college school academy institute station church cathedral temple period alert report street road avenue boulevard
    lane square park garden gardens river lake bay beach island islands mountain mountains valley bridge tower house hall castle palace hotel hospital clinic airport harbour
    museum library theatre theater bank company corporation corp inc ltd llc gmbh group holdings foundation center centre association society club union committee council
    department ministry office court act law day week month year award prize cup league team city town county state district province republic kingdom market mall store
    press times post news journal review award building street universität schule kirche bahnhof straße platz université école église gare rue place universidad
    escuela iglesia calle plaza""".split())
_ARTICLE = re.compile(r"(?:^|[^\w])(?:the|a|an|our|your|their|this|that|every|each|no|der|die|das|den|dem|des|le|la|les|un|une|el|los|las)[ \t]+\Z", re.IGNORECASE)


def _named_after(text: str, end: int) -> bool:
    """Whether a noun of ``_NO_PERSON`` follows: what stands before it is part of its name."""
    m = _LETTERS.match(text, end + 1) if text[end: end + 1] == " " else None
    return bool(m) and m[0][0].isupper() and m[0].casefold() in _NO_PERSON


def _family_gender(name: str, gender: str) -> str:
    """Latin family names have no gender, so that all mentions agree; others show it in their ending."""
    return "n" if script_of(name) == "latin" else gender


# -- surrogates -----------------------------------------------------------------------------------

class _Draw:
    """Numbers from a keyed hash of an entity and the number of the draw."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\0{canonical}\0{attempt}".encode(), hashlib.sha256).digest()
        self.pool, self.n = int.from_bytes(self.seed, "big"), 0

    def below(self, k: int) -> int:
        if self.pool < 1 << 64:
            self.n += 1
            self.pool = int.from_bytes(hashlib.sha256(self.seed + self.n.to_bytes(4, "big")).digest(), "big")
        self.pool, r = divmod(self.pool, k)
        return r

    def digits(self, n: int) -> str:
        return "".join(str(self.below(10)) for _ in range(n))

    def shaped(self, like: str) -> str:
        """Letters for letters and digits for digits."""
        return "".join(chr(97 + self.below(26)) if c.isalpha() else str(self.below(10)) if c.isdigit() else c for c in like)


def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The canonical form of the surrogate that an entity gets at a draw."""
    draw = _Draw(key, kind, canonical, attempt)
    longer = max(0, attempt - GROW + 1)
    mixed = lambda n: "".join("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"[draw.below(36)] for _ in range(n))
    if kind == "email":
        local, _, domain = canonical.partition("@")
        *labels, top = domain.split(".")
        labels = labels[:-1] if len(labels) > 1 and labels[-1] == "example" else labels
        host = _Draw(key, "domain", domain, 0).shaped(".".join(labels))
        return f"{draw.shaped(local + 'x' * longer)}@{host}.example.{top if top in ('com', 'net', 'org') else 'com'}"
    if kind == "phone":
        plain = canonical.lstrip("+")
        if plain == canonical and plain[0] == "0":
            return "0" + str(1 + draw.below(9)) + draw.digits(len(plain) - 2 + longer)
        if plain == canonical and len(plain) == 10:
            return str(2 + draw.below(8)) + draw.digits(2) + str(2 + draw.below(8)) + draw.digits(6 + longer)
        code = 0 if plain == canonical else 1 if plain[0] in "17" else 2  # the country stays
        return canonical[: len(canonical) - len(plain)] + plain[:code] + draw.digits(len(plain) - code + longer)
    if kind == "ip" and (":" in canonical or longer):  # of the range for documentation
        return str(ipaddress.IPv6Address((0x20010DB8 << 96) + int.from_bytes(draw.seed[:12], "big")))
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "card":
        body = canonical[0] + draw.digits(len(canonical) - 2 + longer)
        return next(body + c for c in "0123456789" if luhn(body + c))
    if kind == "ssn":
        return "9" + (mixed(8) if longer else draw.digits(8))
    if kind == "iban":
        body = mixed(len(canonical) - 4 + longer) if longer else "".join(str(draw.below(10)) if c.isdigit() else chr(65 + draw.below(26)) for c in canonical[4:])
        return canonical[:2] + f"{98 - _mod97(canonical[:2] + '00' + body):02d}" + body
    part, script, gender, name = canonical.split(" ", 3)
    draw = _Draw(key, kind, f"{part} {script} {name}", attempt)  # the gender only chooses among the forms
    pool = GIVEN.get((script, gender))
    if part == "given" and pool and attempt == 0:
        return f"{part} {script} {gender} {pool[draw.below(len(pool))].casefold()}"
    syllables = _SYLLABLES[script]
    stem = "".join(syllables[draw.below(len(syllables))] for _ in range(2 + (part == "family") + attempt * (attempt + 1) // 2))  # names grow at once: listed ones are soon used up
    ending = _ENDING[script, gender] if part == "given" else _FAMILY_ENDING.get(script, {}).get(gender, "")
    return f"{part} {script} {gender} {stem}{ending}"


def render(kind: str, original: str, new: str) -> str:
    """A surrogate in the format of the text it replaces."""
    if kind == "name":
        name = new.split(" ", 3)[3]
        word = max(_WORD.findall(original), key=len)
        whole = name.upper() if word.isupper() and len(word) > 1 else name.title()
        letters = iter(name.upper() * (1 + len(original)))
        return _WORD.sub(lambda m: whole if m[0] == word else next(letters), original)
    if kind == "email":
        return new.upper() if original.isupper() else new
    if kind == "ip":
        return new
    chars = iter(new)
    out = [next(chars, "") if c.isalnum() or c == "+" else c for c in original]
    return "".join(out) + "".join(chars)


def draw_surrogates(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, surrogate) for the distinct entities (kind, canonical): no two alike, none an entity itself."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "canonical", "surrogate")])
    done = []
    pending = found
    for attempt in itertools.count():
        def draw(batches: Iterator[pa.RecordBatch], attempt=attempt) -> Iterator[pa.RecordBatch]:
            for b in batches:
                kinds, names = b.column("kind"), b.column("canonical")
                new = [surrogate(key, k, c, attempt) for k, c in zip(kinds.to_pylist(), names.to_pylist())]
                yield pa.RecordBatch.from_arrays([kinds, names, pa.array(new, pa.string())], schema.names)

        drawn = pending.mapInArrow(draw, schema)
        drawn = drawn.withColumn("as", bare(F.col("surrogate")))  # names are told apart without their genders
        free = drawn.join(found.select("kind", bare(F.col("canonical")).alias("as")), ["kind", "as"], "left_anti")
        if done:
            free = free.join(functools.reduce(DataFrame.union, done).select("kind", bare(F.col("surrogate")).alias("as")), ["kind", "as"], "left_anti")
        first = free.groupBy("kind", "as").agg(F.min(F.struct(F.xxhash64("canonical").alias("h"), "canonical", "surrogate")).alias("m"))
        done.append(cut(first.select("kind", "m.canonical", "m.surrogate"), f"surrogates-{attempt}"))
        pending = cut(pending.join(done[-1].select("kind", "canonical"), ["kind", "canonical"], "left_anti"), f"pending-{attempt}")
        if pending.isEmpty():
            return functools.reduce(DataFrame.union, done)


def bare(canonical):
    """The entity of a canonical form, as a column: of a name all but the gender."""
    return F.regexp_replace(canonical, "^(given|family) (latin|cyrillic|greek) [mfn] ", "$1 $2 ")


def settle_genders(mentions: DataFrame) -> DataFrame:
    """(kind, entity, canonical) for the mentions (kind, canonical): one row per entity.

    A name has the gender that more of its mentions show; none if they are as many or show none.
    """
    shown = lambda g: F.when((F.col("kind") == "name") & F.col("canonical").rlike(f"^(given|family) (latin|cyrillic|greek) {g} "), F.col("n")).otherwise(0)
    per_form = mentions.groupBy("kind", "canonical").agg(F.count("*").alias("n"))
    votes = per_form.groupBy("kind", bare(F.col("canonical")).alias("entity"), (F.col("kind") == "name").alias("named")).agg(
        F.sum(shown("m")).alias("m"), F.sum(shown("f")).alias("f"))
    gender = F.when(F.col("m") > F.col("f"), "m").when(F.col("f") > F.col("m"), "f").otherwise("n")
    whole = F.when(F.col("named"), F.concat(F.regexp_extract("entity", r"^(\w+ \w+) ", 1), F.lit(" "), gender, F.lit(" "), F.regexp_extract("entity", r"(?s)^\w+ \w+ (.*)$", 1)))
    return votes.select("kind", "entity", F.coalesce(whole, "entity").alias("canonical"))


_HITS = T.StructType([T.StructField("doc", T.LongType()), T.StructField("doc2", T.LongType()), T.StructField("start", T.IntegerType()),
                      T.StructField("end", T.IntegerType()), *[T.StructField(c, T.StringType()) for c in ("kind", "canonical", "original")]])


def replace_entities(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text, and ``n_entities`` and ``entities``.

    ``entities`` lists kind, start and end in the new text (code points), by start. A null
    text stays null and an empty one empty, both without entities. Columns
    named like an output are replaced; repeated rows are treated alike; an
    empty table gives no rows.
    """
    names = {"n_entities", "entities"}
    others = [c for c in docs.columns if c != text and c.lower() not in names]
    keyed = docs.select(row_hash(docs, 0).alias("doc"), row_hash(docs, 1).alias("doc2"), F.col(f"`{text}`").alias("text"),
                        F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_")).alias("kept"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            rows = []
            for doc, doc2, t in zip(b.column("doc").to_pylist(), b.column("doc2").to_pylist(), utf8(b.column("text"))):
                t = t.decode()
                rows += [(doc, doc2, s, e, kind, c, t[s:e]) for s, e, kind, c in entities(t)]
            kinds = [pa.int64()] * 2 + [pa.int32()] * 2 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 7, kinds)], _HITS.names)

    hits = cut(keyed.select("doc", "doc2", "text").mapInArrow(find, _HITS), "entities")
    settled = cut(settle_genders(hits), "distinct")
    surrogates = draw_surrogates(settled.select("kind", "canonical"), key).select("kind", bare(F.col("canonical")).alias("entity"), "surrogate")
    per_doc = hits.withColumn("entity", bare(F.col("canonical"))).join(surrogates, ["kind", "entity"]).groupBy("doc", "doc2").agg(
        F.sort_array(F.collect_set(F.struct("start", "end", "kind", "original", "surrogate"))).alias("hits"))
    joined = keyed.join(per_doc, ["doc", "doc2"], "left").select("kept", "text", "hits")
    listed = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([joined.schema["kept"], T.StructField("text", T.StringType()), T.StructField("n_entities", T.IntegerType()), T.StructField("entities", listed)])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            texts, spans = [], []
            for t, found in zip(b.column("text").to_pylist(), b.column("hits").to_pylist()):
                pieces, at, length, marks = [], 0, 0, []
                for h in found or ():
                    new = render(h["kind"], h["original"], h["surrogate"])
                    pieces += [t[at: h["start"]], new]
                    length += h["start"] - at + len(new)
                    marks.append({"kind": h["kind"], "start": length - len(new), "end": length})
                    at = h["end"]
                texts.append("".join([*pieces, t[at:]]) if pieces else t)
                spans.append(marks)
            yield pa.RecordBatch.from_arrays(
                [b.column("kept"), pa.array(texts, pa.string()), pa.array(map(len, spans), pa.int32()),
                 pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))], schema.names)

    out = joined.mapInArrow(put, schema)
    return out.select(*[F.col("text").alias(c) if c == text else F.col(f"kept.`{c}`").alias(c) for c in docs.columns if c.lower() not in names], "n_entities", "entities")
