"""Linking the spellings of names that people typed.

Every spelling is rewritten to canonical forms: nicknames become full names, titles and legal forms are
normalised, the order of tokens is dropped, full names also give their abbreviations, and every token its
forms with one letter left out. Spellings meet by equi-joins on the forms. A form's rarity scores the link: how few
people would share it by chance, and for a form with a letter changed how much rarer one of the two words is than the
other, since a slip is rare and a name is not. An abbreviation that two people share links neither.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import DOUBLED, STROKED
from quillspark.operators.graph import connected_components
from quillspark.session import cut

#: Short forms of given names.
NICKNAMES = {
    short: full
    for full, shorts in {
        "abigail": "abby abbie gail", "alexander": "alex sandy sasha", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben benny", "catherine": "cathy cate", "charles": "charlie chuck", "christopher": "chris kit", "constance": "connie", "daniel": "dan danny",
        "deborah": "deb debbie debby", "david": "dave", "donald": "don", "edward": "ed eddie ned", "elizabeth": "liz lizzie beth betsy betty eliza", "frederick": "fred freddie freddy", "gabriella": "gabby gabi gaby ella", "gwendolyn": "gwen", "isabella": "bella izzy isa", "james": "jim jimmy jamie",
        "jennifer": "jen jenny jenn", "jonathan": "jon jonny", "joseph": "joe joey", "josephine": "jo josie", "katherine": "kate kathy katie kat", "kenneth": "ken kenny", "leonard": "len lenny leo", "margaret": "maggie meg peggy", "matthew": "matt", "michael": "mike mick mickey",
        "nicholas": "nick nicky", "patricia": "pat patty trish tricia", "philippa": "pippa", "philip": "phil", "rebecca": "becky becca", "richard": "rick dick rich", "robert": "rob bob bobby robbie bert", "samuel": "sam sammy", "stephanie": "steph steffi", "steven": "steve",
        "susannah": "sue susie suzy", "theodore": "theo ted teddy", "thomas": "tom tommy", "timothy": "tim timmy", "victoria": "vicky vicki tori", "william": "will bill billy willy",
    }.items()
    for short in shorts.split()
}
#: Legal and organisational forms, and their abbreviations.
FORMS = {
    "consortium": "consortium", "consort": "consortium", "group": "group", "grp": "group", "gp": "group", "network": "network", "netw": "network", "collaboration": "collaboration", "collab": "collaboration", "collaborative": "collaboration", "collaborators": "collaboration", "investigators": "investigators", "investigator": "investigators", "invest": "investigators",
    "committee": "committee", "team": "team", "initiative": "initiative", "institute": "institute", "inst": "institute", "university": "university", "univ": "university", "society": "society", "association": "association", "assoc": "association", "inc": "inc", "incorporated": "inc", "ltd": "ltd", "limited": "ltd",
    "corp": "corp", "corporation": "corp", "gmbh": "gmbh", "consortia": "consortium", "project": "project", "registry": "registry", "alliance": "alliance", "taskforce": "taskforce",
}
#: Words beside a form that belong to it.
BESIDE = {"study": "study", "stud": "study", "trial": "trial", "trials": "trial", "working": "working", "research": "research", "res": "research", "writing": "writing", "task": "task", "force": "force"}
#: Before a name, or after it; capitals without a comma may be initials (DR, JR, MD) and stay.
TITLES = regex.compile(r"^\s*(?:(?:Prof(?:essor)?|prof|Dr|dr|Doctor|Mrs?|Ms|Miss|Sir|Rev)\b\.?\s*)+|[,\s]+(?:Ph\.?\s?D|D\.?Phil)\b\.?|,\s*(?:M\.?D|M\.?Sc|B\.?Sc|Jr|Sr|Esq)\b\.?\s*$")
#: Links by a form with a letter changed need this score.
LEAST_SCORE = 0.5
#: A word is taken for a slip of another while it is borne by no more than this share of the other's bearers, and one.
SLIP_SHARE = 0.02
#: Where only the end tells two words apart, as in Maria and Mario or Daniel and Daniela, the one word needs so many
#: bearers, and the other no more than one, to be a slip.
ESTABLISHED = 3
#: Letters that words end with or not to make another name.
ENDINGS = "aeiouy"
STROKES = str.maketrans({**STROKED, **DOUBLED})


def plain(text: str) -> str:
    """Lower-case letters without marks; in longer words oe is o, as ö and ø are often written."""
    folded = unicodedata.normalize("NFKD", text.lower().translate(STROKES))
    folded = regex.sub(r"\p{M}|['’`]", "", folded)
    return folded.replace("oe", "o") if len(folded) >= 6 else folded


GIVEN = {plain(short): plain(full) for short, full in NICKNAMES.items()}


def parse_name(text: str | None) -> dict | None:
    """kind (group or person), tokens of the name (of a person without initials), given (its given tokens if
    the order is known), surname (if only initials stand for the rest) and initials; None if nothing is left.
    """
    if text is None:
        return None
    s = unicodedata.normalize("NFKC", text)
    s = regex.sub(r"[*†‡§¶#\d]+|\(.*?\)", " ", s)
    s = regex.sub(r"\s+", " ", TITLES.sub(" ", s)).strip(" ,;")
    words = [w for w in regex.split(r"[^\p{L}\p{M}'’]+", s) if w]
    if not words:
        return None
    folded = [plain(w) for w in words]
    if any(w in FORMS for w in folded) and len(words) > 1:
        named = sorted(FORMS.get(w, BESIDE.get(w, w)) for w in folded if w not in ("the", "of", "for", "and", "on"))
        core = [w for w in named if w not in FORMS.values() and w not in BESIDE.values()]
        return {"kind": "group", "tokens": core or named, "form": " ".join(w for w in named if w not in core), "given": None, "surname": None, "initials": ""}

    def split(part: str) -> tuple[list[str], str, list[bool]]:
        full, initials, marks = [], "", []
        for w in regex.findall(r"[\p{L}\p{M}'’]+\.?", part):
            bare = w.rstrip(".")
            short = len(bare) == 1 or (bare.isupper() and len(bare) <= 3 and not part.isupper()) or (w.endswith(".") and len(bare) == 1)
            if short:
                initials += plain(bare)
            else:
                full.append(plain(bare))
            marks.append(short)
        return full, initials, marks

    if "," in s:
        left, right = (x.strip() for x in s.split(",", 1))
        surname = split(left.title())[0] or [plain(x) for x in regex.findall(r"[\p{L}\p{M}'’]+", left)]
        dotted = bool(regex.fullmatch(r"(?:\p{Lu}\.?[\s\-]?){1,4}", right))
        given, initials, _ = ([], plain("".join(regex.findall(r"\p{L}", right))), []) if dotted else split(right)
        if not surname:
            return None
        if given:
            return {"kind": "person", "tokens": sorted(surname + [GIVEN.get(g, g) for g in given]), "form": "", "given": [GIVEN.get(g, g) for g in given], "surname": None, "initials": initials}
        return {"kind": "person", "tokens": sorted(surname), "form": "", "given": None, "surname": sorted(surname), "initials": initials} if initials else None
    full, initials, marks = split(s)
    if not full:
        return None
    if initials and (marks[0] or marks[-1]) and (len(full) == 1 or marks[0] or all(not m for m in marks[:-1])):
        return {"kind": "person", "tokens": sorted(full), "form": "", "given": None, "surname": sorted(full), "initials": initials}
    if len(full) == 1:
        return None
    known = None
    if initials:
        before = marks.index(True)
        known = [GIVEN.get(w, w) for w in full[:before]]
    return {"kind": "person", "tokens": sorted(GIVEN.get(w, w) for w in full), "form": "", "given": known, "surname": None, "initials": initials}


SCHEMA = "name string, kind string, tokens array<string>, form string, given array<string>, surname array<string>, initials string"


def parsed_names(names: DataFrame) -> DataFrame:
    """SCHEMA for each of names' rows that is a name."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [{"name": n, **p} for n in b["name"] if (p := parse_name(n))]
            yield pd.DataFrame(rows, columns=["name", "kind", "tokens", "form", "given", "surname", "initials"])

    return names.mapInPandas(scan, SCHEMA)


def spellings(openalex: DataFrame, pubmed: DataFrame, zotero: DataFrame) -> DataFrame:
    """The distinct non-blank names of the three fields, as stored, with the number of their uses."""
    of = lambda df, c: df.select(F.explode(c).alias("name"))
    every = of(openalex, F.transform("authorships", lambda x: x["author"]["display_name"])).union(of(pubmed, F.col("authors"))).union(of(zotero, F.col("authors")))
    return every.where(F.regexp_replace("name", r"(?U)\s+", "") != "").groupBy("name").agg(F.count(F.lit(1)).alias("uses"))


def _key(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def _agree(a: Column, b: Column) -> Column:
    """Whether two runs of initials can belong to one person: one begins the other."""
    return a.startswith(b) | b.startswith(a)


def deletions(word: Column) -> Column:
    """A word and its forms without one letter, none below three letters."""
    return F.when(F.length(word) < 3, F.array(word)).otherwise(
        F.concat(F.array(word), F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word)))))
    )


def one_edit(a: Column, b: Column) -> Column:
    """One letter put in, left out or replaced, or two neighbours exchanged. Two words share a form without
    one letter in a few other cases too."""
    apart = F.levenshtein(a, b)
    return (apart <= 1) | ((apart == 2) & (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, ""))))


def link_names(names: DataFrame) -> DataFrame:
    """name, person (a class id), rule, score for every name of `names` (column name, distinct) that can be parsed.

    Full names are one person if their tokens are, in any order and by full given names, unless their middle
    initials differ; a full name without one joins them only if all with one agree. An abbreviation joins the
    one full name it can stand for; if there are several it stays alone, and if there is none it joins equal
    abbreviations. Names that differ by one letter in one token, or by two neighbours exchanged, are linked
    if their middle initials agree and edit_score is LEAST_SCORE at least. Names that can't be parsed have no row.
    score is the rarity of the form that ties a spelling to its class, in 0..1: 1 / (1 + others), others being how many
    further people are expected to have the form if words and initials were borne independently; for a spelling
    tied by a changed letter the score of that change too; a spelling that stands alone by ambiguity has 1 / meanings.
    Everything is joined on forms; a common form is never expanded into pairs of spellings.
    """
    parsed = cut(parsed_names(names.select("name")))
    group = parsed.where("kind = 'group'").select("name", F.concat(F.lit("g|"), F.col("form"), F.lit("|"), _key("tokens")).alias("person"), "tokens", "form")
    full = parsed.where("kind = 'person' AND surname IS NULL").withColumn("key", _key("tokens"))
    short = parsed.where("kind = 'person' AND surname IS NOT NULL").withColumn("family", _key("surname"))

    # full names: one person for each (tokens, middle initials)
    middles = full.where("initials != ''").groupBy("key").agg(F.max(F.struct(F.length("initials"), "initials"))["initials"].alias("longest"), F.min("initials").alias("least"), F.max("initials").alias("greatest"))
    # all agree if the longest begins with the least and the greatest: strings between them share their start
    middles = middles.withColumn("one", F.col("longest").startswith(F.col("least")) & F.col("longest").startswith(F.col("greatest")))
    full = full.join(middles.select("key", "longest", "one"), "key", "left")
    middle = F.when(F.coalesce("one", F.lit(True)), F.coalesce("longest", F.lit(""))).otherwise(F.col("initials"))
    full = cut(full.withColumn("middle", middle).withColumn("person", F.concat_ws("|", F.lit("p"), "key", "middle")))
    ordered = full.where("given IS NOT NULL").groupBy("key").agg(F.max("given").alias("known"))
    people = full.groupBy("person", "key", "middle").agg(F.first("tokens").alias("tokens"), F.count(F.lit(1)).alias("spellings")).join(ordered, "key", "left")

    # how many people bear a word, and how many there are
    borne = cut(people.select("key", F.explode(F.array_distinct("tokens")).alias("token")).distinct().groupBy("token").agg(F.count(F.lit(1)).alias("df")))
    everyone = people.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("n"))

    # full names and groups one letter apart
    def close(df: DataFrame, same: str, least: int) -> DataFrame:
        at = df.select("person", "tokens", same, F.posexplode("tokens").alias("_i", "_t"))
        rest = _key(F.array_sort(F.transform(F.filter(F.col("tokens"), lambda t, k: k != F.col("_i")), lambda t: t)))
        keyed = at.where((F.length("_t") >= 2) & (F.length(rest) >= least)).withColumn("_d", F.explode(deletions(F.col("_t")))).select("person", F.col(same).alias("same"), "_t", F.concat_ws("|", rest, "_d").alias("form"))
        x, y = keyed.alias("x"), keyed.alias("y")
        return x.join(y, (F.col("x.form") == F.col("y.form")) & (F.col("x.person") < F.col("y.person")) & one_edit(F.col("x._t"), F.col("y._t"))).select(F.col("x.person").alias("a"), F.col("y.person").alias("b"), F.col("x._t").alias("ta"), F.col("y._t").alias("tb"), F.col("x.same").alias("sa"), F.col("y.same").alias("sb")).distinct()

    pairs = close(people, "middle", 3).where(_agree(F.col("sa"), F.col("sb")))
    pairs = pairs.join(borne.withColumnsRenamed({"token": "ta", "df": "da"}), "ta").join(borne.withColumnsRenamed({"token": "tb", "df": "db"}), "tb").withColumn("score", edit_score(*(F.col(x) for x in ("ta", "tb", "da", "db")))).where(F.col("score") >= LEAST_SCORE).select("a", "b", "score")
    group_people = group.groupBy("person", "form").agg(F.first("tokens").alias("tokens"))
    pairs = cut(pairs.unionByName(close(group_people, "form", 0).where("sa = sb").select("a", "b", F.lit(1.0).alias("score"))))
    links = pairs.select("a", "b")
    edited = pairs.select(F.explode(F.array("a", "b")).alias("person"), "score").groupBy("person").agg(F.max("score").alias("edit"))
    classes = connected_components(links).select(F.col("node").alias("person"), "component")
    person_class = lambda df: df.join(classes, "person", "left").withColumn("person", F.coalesce("component", "person")).drop("component")
    # abbreviations of every person: the known given tokens, else each token, and all but each, in turn
    givens = F.when(F.col("known").isNotNull(), F.array("known")).otherwise(F.concat(F.transform("tokens", lambda t: F.array(t)), F.transform("tokens", lambda t: F.array_except("tokens", F.array(t)))))
    letters = F.array_join(F.transform("given", lambda g: F.substring(g, 1, 1)), "")
    forms = people.select("person", "tokens", "middle", F.explode(givens).alias("given")).select(
        "person", _key(F.array_sort(F.array_except("tokens", "given"))).alias("family"), F.explode(F.array_distinct(F.concat(F.array(F.concat(letters, "middle")), F.transform("given", lambda g: F.concat(F.substring(g, 1, 1), F.col("middle")))))).alias("full_initials"), (F.col("middle") != "").alias("has_middle")
    ).where("family != ''")
    # counted by class: a name and its misspelling are one meaning
    forms = cut(person_class(forms).distinct())
    abbreviations = short.groupBy("family", "initials").agg(F.count(F.lit(1)).alias("spellings"))
    fits = (F.col("a.family") == F.col("f.family")) & fits_initials("a.initials", "f.full_initials", "f.has_middle")
    met = abbreviations.alias("a").join(forms.alias("f"), fits).select("a.family", "a.initials", "f.person").distinct()
    meant = met.groupBy("family", "initials").agg(F.count(F.lit(1)).alias("_n"), F.max("person").alias("person"))
    # one letter off: an abbreviation that no full name has, by its family name's deletion forms
    stray = abbreviations.join(meant, ["family", "initials"], "left_anti").where(F.length("family") >= 6)
    near_fits = (F.col("a.form") == F.col("f.form")) & one_edit(F.col("a.family"), F.col("f.family")) & fits_initials("a.initials", "f.full_initials", "f.has_middle")
    near = (
        stray.select("family", "initials", F.explode(deletions(F.col("family"))).alias("form")).alias("a")
        .join(forms.where(F.length("family") >= 6).select("person", "family", "full_initials", "has_middle", F.explode(deletions(F.col("family"))).alias("form")).alias("f"), near_fits)
        .select("a.family", "a.initials", "f.person").distinct()
        .groupBy("family", "initials").agg(F.count(F.lit(1)).alias("_n"), F.max("person").alias("person"))
    )
    meant = meant.unionByName(near)
    alone = F.concat_ws("|", F.lit("s"), "family", F.when(F.col("_n") > 1, F.concat_ws("|", "initials", "name")).otherwise(F.substring("initials", 1, 1)))
    # people expected to have a family's initials by chance: of those with the family name, the share with the first letter
    kin = forms.select("family", "person").distinct().groupBy("family").agg(F.count(F.lit(1)).alias("kin"))
    letters_of = forms.select(F.substring("full_initials", 1, 1).alias("letter"), "person").distinct().groupBy("letter").agg(F.count(F.lit(1)).alias("_l"))
    everyone_once = forms.agg(F.greatest(F.countDistinct("person"), F.lit(1)).alias("n"))
    by_letter = letters_of.select("letter", (F.col("_l") / everyone_once.scalar()).alias("share"))  # a row for each letter
    short_person = (
        short.join(meant, ["family", "initials"], "left").join(kin, "family", "left").withColumn("letter", F.substring("initials", 1, 1)).join(F.broadcast(by_letter), "letter", "left")
        .select("name", F.when(F.col("_n") == 1, F.col("person")).otherwise(alone).alias("person"), F.when(F.col("_n") == 1, "initials").otherwise("alone").alias("rule"),
                F.when(F.col("_n") > 1, 1 / F.col("_n")).otherwise(1 / (1 + F.greatest(F.coalesce("kin", F.lit(1)) - 1, F.lit(0)) * F.coalesce("share", F.lit(1.0)))).alias("score"))
    )
    # people expected to have a full name by chance: of all, the product of its words' shares
    chance = people.select("person", F.explode("tokens").alias("token")).join(borne, "token").groupBy("person").agg(F.sum(F.log(F.col("df") / everyone.scalar())).alias("_log"))
    rarity = chance.select("person", (1 / (1 + F.exp(F.col("_log")) * everyone.scalar())).alias("rarity"))
    named = full.select("name", "person").join(rarity, "person", "left").unionByName(group.select("name", "person").withColumn("rarity", F.lit(1.0))).join(edited, "person", "left")
    named = named.select("name", "person", F.when(F.col("edit").isNotNull(), "edit").otherwise("full").alias("rule"), (F.coalesce("rarity", F.lit(1.0)) * F.coalesce("edit", F.lit(1.0))).alias("score"))
    return person_class(named).select("name", "person", "rule", F.round("score", 4).alias("score")).unionByName(short_person.withColumn("score", F.round("score", 4)))


def edit_score(a: Column, b: Column, da: Column, db: Column) -> Column:
    """How rare the rarer of two words one letter apart is, beside what slips of the other would give: 1 / the bearers
    that slips don't explain. Words that differ by a vowel at the end alone are two names unless the one is
    established and the other is borne by one."""
    rarer, commoner = F.least(da, db), F.greatest(da, db)
    shorter, longer = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    stem = F.when(F.length(a) == F.length(b), F.substring(shorter, F.lit(1), F.length(shorter) - 1)).otherwise(shorter)
    ends = longer.startswith(stem) & F.substring(longer, -1, 1).isin(*ENDINGS) & ((F.length(a) != F.length(b)) | F.substring(shorter, -1, 1).isin(*ENDINGS))
    plain = 1 / F.greatest(F.lit(1.0), rarer - SLIP_SHARE * commoner)
    return F.when(ends & ~((rarer == 1) & (commoner >= ESTABLISHED)), plain / 4).otherwise(plain)


def fits_initials(short: str, long: str, has_middle: str) -> Column:
    return (F.substring(short, 1, 1) == F.substring(long, 1, 1)) & (F.col(long).startswith(F.col(short)) | (~F.col(has_middle) & F.col(short).startswith(F.col(long))))


def with_links(linked: DataFrame) -> DataFrame:
    """linked with `links`, the number of the class's other spellings: one row for each spelling, whatever the
    class's size."""
    sizes = linked.groupBy("person").agg(F.count(F.lit(1)).alias("_n"))
    return linked.join(sizes, "person").withColumn("links", F.col("_n") - 1).select("name", "person", "rule", "score", "links")


def name_pairs(linked: DataFrame) -> DataFrame:
    """name_lo, name_hi of the different spellings of one person; a person's spellings are few, however many
    rows use them."""
    a, b = linked.alias("a"), linked.alias("b")
    return a.join(b, (F.col("a.person") == F.col("b.person")) & (F.col("a.name") < F.col("b.name"))).select(F.col("a.name").alias("name_lo"), F.col("b.name").alias("name_hi")).distinct()
