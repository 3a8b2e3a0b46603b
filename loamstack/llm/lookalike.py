"""One form for texts that look the same: widths, separate accents, joined letters, look-alike letters, blanks, invisible characters.

The mapping is worked out once from Unicode's own data plus a list of look-alike letters, and checked for conflicts: it must leave
its own results alone. A transducer applies it in one pass: an automaton over classes of characters finds the longest grapheme cluster at each
place (a base with all its marks, a syllable of parts, a joined emoji), and the cluster's image is written. Letter case, accents,
raised digits and the make-up of emoji stay.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamstack.config import cut

COPIES = 1 << 12  # copies of one text that are joined in one group

# fixed values: letters of other scripts that look like Latin ones
LOOKALIKES = (
    # Cyrillic
    "А A  В B  Е E  Ѕ S  І I  Ј J  К K  М M  Н H  О O  Р P  С C  Т T  У Y  Х X  Ԍ G  Ԛ Q  Ԝ W  Ӏ I  Ѵ V  Ү Y  Һ h "
    "а a  е e  ѕ s  і i  ј j  о o  р p  с c  у y  х x  һ h  ԁ d  ԛ q  ԝ w  ѵ v  ӏ l  ү y "
    # Greek
    "Α A  Β B  Ε E  Ζ Z  Η H  Ι I  Κ K  Μ M  Ν N  Ο O  Ρ P  Τ T  Υ Y  Χ X  ο o  ν v  ρ p  ϲ c  Ϲ C  ϳ j  Ϳ J "
    # Armenian
    "Օ O  Ս U  օ o  ս u  հ h  ո n "
    # Cherokee
    "Ꭰ D  Ꭱ R  Ꭲ T  Ꭺ A  Ꭻ J  Ꭼ E  Ꮃ W  Ꮇ M  Ꮋ H  Ꮍ Y  Ꮐ G  Ꮓ Z  Ꮩ V  Ꮪ S  Ꮮ L  Ꮯ C  Ꮲ P  Ꮶ K  Ᏼ B "
    # Coptic
    "Ⲃ B  Ⲏ H  Ⲓ I  Ⲕ K  Ⲙ M  Ⲛ N  Ⲟ O  ⲟ o  Ⲣ P  ⲣ p  Ⲥ C  ⲥ c  Ⲧ T  Ⲩ Y  Ⲭ X "
    # Lisu
    "ꓐ B  ꓑ P  ꓓ D  ꓔ T  ꓖ G  ꓗ K  ꓙ J  ꓚ C  ꓜ Z  ꓝ F  ꓟ M  ꓠ N  ꓡ L  ꓢ S  ꓣ R  ꓦ V  ꓧ H  ꓪ W  ꓫ X  ꓬ Y  ꓮ A  ꓰ E  ꓲ I  ꓳ O  ꓴ U "
    # letters of phonetic and other Latin blocks with the shape of a plain one
    "ɡ g  ᴏ o  ᴠ v  ᴡ w  ᴢ z "
).replace("Һ h ", "").split()

EMOJI_RANGES = "\U0001f000-\U0001faff←-⇿⌀-⏿①-➿⤀-⥿⬀-⯿〰〽㊗㊙©®"
_JOINED = ("<initial>", "<medial>", "<final>", "<isolated>")
_WIDTH = ("<wide>", "<narrow>")


def _invisible(ch: str) -> bool:
    o = ord(ch)
    return unicodedata.category(ch) == "Cf" and not 0x600 <= o <= 0x605 and o not in (0x6DD, 0x70F, 0x8E2, 0x110BD) or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF or o in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0x180B <= o <= 0x180F


@functools.cache
def tables() -> tuple[dict[int, str], list[int], list[int]]:
    """The mapping of single characters, all marks and all invisible characters."""
    alike = dict(zip(LOOKALIKES[::2], LOOKALIKES[1::2], strict=True))
    nfc, nfd = (lambda s: unicodedata.normalize("NFC", s)), (lambda s: unicodedata.normalize("NFD", s))

    def simple(ch: str) -> str:
        if _invisible(ch):
            return ""
        if unicodedata.category(ch) == "Zs":
            return " "
        d = unicodedata.decomposition(ch)
        if d.startswith("<"):
            tag, *codes = d.split()
            parts = "".join(chr(int(x, 16)) for x in codes)
            letters = all(unicodedata.category(x)[0] in "LM" for x in parts)
            if tag in _WIDTH or tag in _JOINED or tag == "<compat>" and letters and (len(parts) > 1 or "ROMAN NUMERAL" in unicodedata.name(ch, "")):
                return "".join(simple(x) for x in parts)
            if tag == "<noBreak>":
                return parts
            return ch
        return "".join(alike.get(x, x) for x in nfd(ch))

    table, marks, unseen = {}, [], []
    for o in range(0x80, sys.maxunicode + 1):
        ch = chr(o)
        cat = unicodedata.category(ch)
        if cat in ("Cn", "Co", "Cs") or 0xAC00 <= o <= 0xD7A3 or 0x4E00 <= o <= 0x9FFF:
            continue
        if cat[0] == "M" and not _invisible(ch):
            marks.append(o)
        to = nfc(simple(ch))
        if _invisible(ch):
            unseen.append(o)
        if to != ch:
            table[o] = to
    # conflicts: what a rule writes must not be rewritten by another
    for o, to in table.items():
        again = nfc("".join(table.get(ord(x), x) for x in to))
        if again != to:
            raise ValueError(f"rules conflict on U+{o:04X}: {to!r} becomes {again!r}")
    return table, marks, unseen


# classes of characters
OTHER, MARK, UNSEEN, EMOJI, VARIANT, JOINER, TONE, KEY, LEAD, VOWEL, TAIL, SYLLABLE, LINE = range(13)
# states of the automaton over them: what has been read of a cluster
_BASE, _HIDDEN, _CLUSTER, _PICTURE, _STYLED, _JOIN, _JOINED_UP, _KEYCAP, _LEADING, _TWO, _THREE, _BLOCK, _DONE, _MORE, _LINK = range(1, 16)
_MOVES = {
    0: {OTHER: _BASE, MARK: _DONE, UNSEEN: _DONE, VARIANT: _DONE, JOINER: _DONE, TONE: _PICTURE, EMOJI: _PICTURE, KEY: _KEYCAP, LEAD: _LEADING, VOWEL: _BASE, TAIL: _BASE, SYLLABLE: _BLOCK, LINE: _DONE},
    _BASE: {MARK: _CLUSTER, UNSEEN: _HIDDEN, VARIANT: _HIDDEN, JOINER: _HIDDEN},
    _HIDDEN: {MARK: _CLUSTER, UNSEEN: _HIDDEN, VARIANT: _HIDDEN, JOINER: _HIDDEN},
    _CLUSTER: {MARK: _CLUSTER, UNSEEN: _CLUSTER, VARIANT: _CLUSTER, JOINER: _CLUSTER},
    _PICTURE: {MARK: _CLUSTER, UNSEEN: _HIDDEN, VARIANT: _STYLED, TONE: _STYLED, JOINER: _JOIN},
    _STYLED: {VARIANT: _MORE, TONE: _MORE, JOINER: _LINK},
    _MORE: {VARIANT: _MORE, TONE: _MORE, JOINER: _LINK},
    _LINK: {EMOJI: _JOINED_UP, TONE: _JOINED_UP},
    _JOIN: {EMOJI: _JOINED_UP, TONE: _JOINED_UP, MARK: _CLUSTER, UNSEEN: _HIDDEN, VARIANT: _HIDDEN, JOINER: _HIDDEN},
    _JOINED_UP: {VARIANT: _JOINED_UP, TONE: _JOINED_UP, JOINER: _LINK},
    _KEYCAP: {VARIANT: _STYLED, MARK: _CLUSTER, UNSEEN: _HIDDEN, JOINER: _HIDDEN},
    _LEADING: {VOWEL: _TWO, MARK: _CLUSTER, UNSEEN: _HIDDEN, VARIANT: _HIDDEN, JOINER: _HIDDEN},
    _TWO: {TAIL: _THREE},
    _THREE: {},
    _BLOCK: {TAIL: _THREE, MARK: _CLUSTER, UNSEEN: _HIDDEN, VARIANT: _HIDDEN, JOINER: _HIDDEN},
    _DONE: {},
}
# what may be written when the longest cluster ends in a state: one character's image, a composed image, or the cluster as it is
_ONE_IMAGE, _COMPOSED, _AS_IS = 1, 2, 3
_ENDS = {_BASE: _ONE_IMAGE, _PICTURE: _ONE_IMAGE, _KEYCAP: _ONE_IMAGE, _LEADING: _ONE_IMAGE, _BLOCK: _ONE_IMAGE, _DONE: _ONE_IMAGE, _CLUSTER: _COMPOSED, _TWO: _COMPOSED, _THREE: _COMPOSED, _STYLED: _AS_IS, _JOINED_UP: _AS_IS}


class Transducer:
    """`apply(text)` gives the one form; idempotent."""

    def __init__(self) -> None:
        self.table, marks, unseen = tables()
        self.classes: dict[str, int] = {}
        emoji = re.compile(f"[{EMOJI_RANGES}]")
        for o in [*range(0x203C, 0x3300), *range(0x1F000, 0x1FB00), 0xA9, 0xAE]:
            if emoji.match(chr(o)):
                self.classes[chr(o)] = EMOJI
        for span, kind in (((0x1100, 0x1113), LEAD), ((0x1161, 0x1176), VOWEL), ((0x11A8, 0x11C3), TAIL), ((0xAC00, 0xD7A4), SYLLABLE), ((0x1F3FB, 0x1F400), TONE)):
            self.classes.update((chr(o), kind) for o in range(*span))
        self.classes.update((c, KEY) for c in "0123456789#*")
        self.classes.update((chr(o), MARK) for o in marks)
        self.classes.update((chr(o), UNSEEN) for o in unseen)
        self.classes |= {"\ufe0f": VARIANT, "\u200d": JOINER, "\n": LINE}
        # only characters beyond ASCII, with the one before as a possible base, are ever looked at; words recur, so do pieces
        self.piece = re.compile(r"[ -~]?[^\x00-\x7f]+")
        self.known: dict[str, str] = {}

    def rewrite(self, s: str) -> str:
        """The transducer's run over `s`: at each place the longest cluster is read and its image written."""
        classes, table, out, n, i = self.classes, self.table, [], len(s), 0
        kinds = [classes.get(c, OTHER) for c in s]
        while i < n:
            state, j, last, write = 0, i, i + 1, _ONE_IMAGE
            while j < n:
                state = _MOVES[state].get(kinds[j])
                if state is None:
                    break
                j += 1
                end = _ENDS.get(state)
                # a syllable of parts ends where no mark follows
                if end and not (state in (_TWO, _THREE) and j < n and kinds[j] == MARK):
                    last, write = j, end
            if write == _ONE_IMAGE:
                c = s[i]
                out.append(table.get(ord(c), c))
            elif write == _COMPOSED:
                out.append(unicodedata.normalize("NFC", unicodedata.normalize("NFD", s[i:last]).translate(table)))
            else:
                out.append(s[i:last])
            i = last
        return "".join(out)

    def _piece(self, m: re.Match) -> str:
        s = m.group()
        out = self.known.get(s)
        if out is None:
            out = self.rewrite(s)
            if len(self.known) >= 200_000:  # a cache, not a result: emptied when full
                self.known.clear()
            if len(s) <= 64:
                self.known[s] = out
        return out

    def apply(self, text: str) -> str:
        return text if text.isascii() else self.piece.sub(self._piece, text)


_ONE: Transducer | None = None


def transducer() -> Transducer:
    """The process's own transducer, built on first use."""
    global _ONE
    if _ONE is None:
        _ONE = Transducer()
    return _ONE


def visual_form(text: str) -> str:
    return transducer().apply(text)


def visual_column(text: Column) -> Column:
    """The one form of a text column; NULL stays NULL, the empty text stays empty. Texts are read whole, in Arrow batches."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = transducer()
        for s in parts:
            yield pd.Series([None if x is None else t.apply(x) for x in s], dtype=object)

    return F.pandas_udf(run, "string").asNondeterministic()(text)


def _stored_forms(df: DataFrame, identifier: str, text: str) -> DataFrame:
    """(id, form, raw): hashes of the form and of the stored text of each row, worked out once."""
    rows = df.select(F.col(identifier).alias("id"), F.col(text).alias("t")).where("t IS NOT NULL")
    # stored texts in one form are told apart by their own hash; ASCII texts skip Python
    plain = rows.where(~F.col("t").rlike(r"[^\x00-\x7f]")).select("id", F.sha2("t", 256).alias("form"), F.sha2("t", 256).alias("raw"))
    other = rows.where(F.col("t").rlike(r"[^\x00-\x7f]")).select("id", F.sha2(visual_column(F.col("t")), 256).alias("form"), F.sha2("t", 256).alias("raw"))
    return cut(plain.unionByName(other))


def same_look_classes(df: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """(form, raw, first_id, rows) of the stored texts whose form has several: a row a class of equal texts, copies not expanded."""
    classes = _stored_forms(df, identifier, text).groupBy("form", "raw").agg(F.min("id").alias("first_id"), F.count("*").alias("rows"))
    several = classes.groupBy("form").agg(F.count("*").alias("k")).where("k > 1").select("form")
    return classes.join(several, "form", "left_semi")


def same_look_pairs(df: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs (id_a < id_b) of rows whose texts differ as stored but have one form. NULL texts match nothing.

    Rows are reduced to hashes of the form and of the stored text. Only forms with several stored texts go on, as classes of
    equal texts; members are joined to pairs of classes, so copies are never compared with each other. A class of very many
    copies is joined in parts.
    """
    rows = _stored_forms(df, identifier, text)
    classes = rows.groupBy("form", "raw").agg(F.count("*").alias("k"))
    several = classes.groupBy("form").agg(F.count("*").alias("raws")).where("raws > 1").select("form")
    classes = cut(classes.join(several, "form", "left_semi").withColumn("parts", F.ceil(F.col("k") / COPIES).cast("int")))
    a = classes.select("form", F.col("raw").alias("ra"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("pa"))
    b = classes.select("form", F.col("raw").alias("rb"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("pb"))
    pairs = a.join(b, "form").where("ra < rb")
    members = rows.join(classes.select("form", "raw", "parts"), ["form", "raw"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    x = pairs.join(members.select("form", F.col("raw").alias("ra"), F.col("part").alias("pa"), F.col("id").alias("x")), ["form", "ra", "pa"])
    y = x.join(members.select("form", F.col("raw").alias("rb"), F.col("part").alias("pb"), F.col("id").alias("y")), ["form", "rb", "pb"])
    return y.where("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
