"""Files nobody wrote by hand for their repository: generated, minified, vendored, and data stored as code.

Plain marks are a path, a leading notice and token composition. Weak marks of another's code (a folder with a version number, a
remark on where the code comes from) count only for copies, which an inverted index of line hashes finds: files of other repositories
that share one of a file's rarest lines are candidates, so many lines that no source is missed, and the share of a file's lines that
the other file contains is computed exactly, so edited copies are found too. Resemblance without any mark marks no file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamstack.config import cut

# fixed values: folders that hold other people's code
VENDOR_DIRS = set("vendor vendors vendored _vendor third_party third-party thirdparty 3rdparty 3rd_party external externals extern deps godeps node_modules bower_components jspm_packages pods carthage site-packages".split())
# fixed values: folders that hold a program's output
OUTPUT_DIRS = set("generated generated-sources generated_sources generated-src __generated__ autogenerated autogen".split())
OUTPUT_NAME = re.compile(r"(?:\.pb(?:\.gw)?\.(?:go|cc|h|c|rs|swift)|\.pb-c\.[ch]|_pb2(?:_grpc)?\.pyi?|_(?:grpc_)?pb\.(?:js|d\.ts|ts)|[._]gen(?:erated)?\.(?:rs|go|c|h|js|ts|py|java|cs)|\.g\.(?:dart|cs|i\.cs)|\.designer\.cs|^(?:moc|ui|qrc)_\w+\.(?:h|cpp|py)|\.tab\.[ch]|\.yy\.c)$")
LOCK_NAME = re.compile(r"^(?:.*[.\-]lock(?:\.json|\.ya?ml|file)?|package-lock\.json|npm-shrinkwrap\.json|go\.sum|gopkg\.lock|pipfile\.lock|poetry\.lock|cargo\.lock|.*\.lock\.hcl)$")
MINIFIED_NAME = re.compile(r"(?:[.\-_]min|\.bundle|\.chunk|\.pack(?:ed)?)\.(?:m?js|cjs|css)$")
NOTICE = re.compile(
    r"(?i)code generated by\b|\bdo not (?:edit|modify)\b(?! the)|@generated\b|<auto-?generated\b|</auto-?generated>|auto-?generated (?:file|by|from|code)|^[\s\W]*autogenerated\b|(?:file|code) (?:was|is|has been) (?:auto(?:matically)?[- ]?)?(?:generated|written|produced|created) by (?:a program|the|an?\b|\w+)|\bgenerated (?:automatically )?(?:by|from|using|with) |(?:edits|changes) (?:to this file )?will be (?:lost|overwritten)|machine[- ](?:output|generated)\b"
    r"|automatisch (?:erzeugt|generiert)|nicht von hand (?:ändern|aendern|bearbeiten)|généré automatiquement|ne pas (?:modifier|éditer)|generado automáticamente|no (?:editar|modificar)\b|сгенерирован|не редактировать"
)
NOT_NOTICE = re.compile(r"(?i)\btodo\b|\bfixme\b|\bnot (?:auto-?)?generated\b|\bhand-?written\b|don't minify")
COPY_NOTICE = re.compile(r"(?i)\bvendored (?:from|copy|version|in)\b|\bthird[- ]party (?:code|copy|file|library|source)\b|\b(?:copied|imported|taken|borrowed|adapted|derived) (?:verbatim |unchanged |unmodified )?from (?:https?:|the upstream|upstream|the project|[\w.\-]+ v?\d+\.\d+)|\b(?:verbatim|unmodified|local) copy of\b|\bupstream(?: version| source|:| project| release)|\bbundled (?:copy|from)\b|\bmirrored from\b")
COMMENT = re.compile(r"\s*(?:#(?!\s*(?:include|define|pragma|if|ifdef|ifndef|endif)\b|!?\[)|//|/\*|\*|--|;|<!--|\"\"\"|''')")
PLAIN_NAME = re.compile(r"^(?:licen[cs]e|copying|notice|authors|contributors|readme|changes|changelog)(?:[.\-][\w.\-]*)?$|\.(?:md|rst|txt|pem|key|crt|cer|env)$|^\.env")
# weak marks: folders that often hold other people's code, names with a version, remarks on where code comes from
WEAK_DIR = re.compile(r"^(?:contrib|libs|ext|compat|bundled|embedded|forks?|thirdparty[\w\-]*|.*[\w\-]*[-@_]v?\d+\.\d+[\w.\-]*)$")
WEAK_NOTICE = re.compile(r"(?i)\b(?:based (?:up)?on|adapted from|derived from|borrowed from|copied from|taken from|a? ?port(?:ed)? (?:of|from)|backport(?:ed)? (?:of|from)|fork(?:ed)? (?:of|from)|originally (?:from|by|written|part of)|original (?:source|code|author|version)|part of the [\w\-]+ (?:library|project|package))\b|\b(?:homepage|upstream|origin|source|url|website)\s*:\s*https?://|^[\s\W]*[\w.\-]+ v\d+\.\d+")
KEY_FILE = re.compile(r"\s*-----BEGIN [A-Z0-9 ]*KEY-----")
NUMBERS = re.compile(r"[-+]?\d[\d.eE+\-]*\s*[,\]]")
BLOB_LINE = re.compile(r"""\s*[+.]?\s*(?:[bru]?["'`(\[{])*\s*(?:(?=[A-Za-z0-9+/=\\]*[A-Z0-9+/])[A-Za-z0-9+/=\\]{40,}|(?:(?:0x[0-9A-Fa-f]{1,8}|\\x[0-9A-Fa-f]{2}|-?\d+(?:\.\d+)?)[uUlLfF]?\s*,?\s*){6,})["'`)\]};,+\\ ]*\r?$""")
DOCUMENTS = {"markdown", "text", "dotenv"}
CONFIG = {"json", "yaml", "toml", "xml", "ini"}
CODE = {"python", "javascript", "go", "java", "rust", "c", "shell"}
CODE_KINDS = {"js", "mjs", "cjs", "jsx", "ts", "tsx", "css"}


def leading_notice(text: str) -> str:
    """The comments and the docstring before the first line of code."""
    out, inside = [], None
    for line in text.split("\n"):
        s = line.strip()
        if inside:
            out.append(s)
            if inside in s:
                inside = None
            continue
        if not s or s.startswith("#!") or s in ('"use strict";', "'use strict';", "<?php"):
            continue
        if not COMMENT.match(line):
            break
        out.append(s)
        for a, b in (("/*", "*/"), ('"""', '"""'), ("'''", "'''"), ("<!--", "-->")):
            if s.startswith(a) and b not in s[len(a) :]:
                inside = b
    return "\n".join(out)


BLOB_HINT = re.compile(r"[A-Za-z0-9+/=\\]{40}|(?:(?:0x[0-9A-Fa-f]+|\d+(?:\.\d+)?),\s?){5}|(?:\\x[0-9A-Fa-f]{2}){8}")


def blob_share(text: str) -> float:
    """Share of characters on lines that are nothing but encoded text or numbers."""
    if not BLOB_HINT.search(text):
        return 0.0
    return sum(len(x) + 1 for x in text.split("\n") if len(x) >= 24 and BLOB_LINE.match(x)) / max(1, len(text))


def number_share(text: str) -> float:
    """Share of characters that are elements of lists of numbers, with the brackets and blanks around them."""
    return sum(map(len, NUMBERS.findall(text))) / max(1, len(text) - sum(map(text.count, " \n\t\r[")))


def is_minified(text: str) -> bool:
    """Hardly any blanks, long lines and dense signs, as no hand leaves them. The longest line need not be the first."""
    n = len(text)
    if n < 60:
        return False
    lines = text.count("\n") + 1
    blanks = text.count(" ") + text.count("\t") + lines
    signs = sum(map(text.count, "{}();,=."))
    return blanks / n < 0.09 and signs / n > 0.12 and n / lines > 80


def marks(path: str | None, text: str | None, language: str | None) -> tuple[str | None, bool]:
    """(`generated`, `minified`, `vendored`, `data` or None; has it a weak mark of another's code?) of one file. NULLs count as empty."""
    p = (path or "").replace("\\", "/").lower()
    *dirs, name = p.split("/")
    text, lang = text or "", (language or "").strip().lower()
    if LOCK_NAME.match(name) or name.endswith(".json") and '"lockfileVersion"' in text or text.count('"integrity":') > 3 and '"resolved":' in text:
        return "generated", False
    if PLAIN_NAME.search(name) and lang not in CODE or lang in DOCUMENTS or not text.strip() or KEY_FILE.match(text):
        return None, False
    head = leading_notice(text)
    if head:
        for line in re.sub(r"[\s*#/]*\n[\s*#/]*", " ", head), *head.split("\n"):
            if NOTICE.search(line) and not NOT_NOTICE.search(line):
                return "generated", False
    if lang in CONFIG:
        return "data" if len(text) > 200 and number_share(text) > 0.6 else None, False
    if OUTPUT_NAME.search(name) or OUTPUT_DIRS & set(dirs) or "target/out/" in p:
        return "generated", False
    if MINIFIED_NAME.search(name) or (name.rpartition(".")[2] in CODE_KINDS or lang == "javascript") and is_minified(text):
        return "minified", False
    if VENDOR_DIRS & set(dirs) or head and COPY_NOTICE.search(head):
        return "vendored", False
    if blob_share(text) > 0.5:
        return "data", False
    return None, any(map(WEAK_DIR.match, dirs)) or bool(head and WEAK_NOTICE.search(head))


def origin(path: str | None, text: str | None, language: str | None) -> str | None:
    """The plain mark of one file."""
    return marks(path, text, language)[0]


def marks_column(path: Column, text: Column, language: Column) -> Column:
    """struct(origin, weak) of each file."""

    def run(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for p, t, g in parts:
            yield pd.DataFrame([marks(a, b, c) for a, b, c in zip(p, t, g)], columns=["origin", "weak"])

    return F.pandas_udf(run, "origin string, weak boolean").asNondeterministic()(path, text, language)


BROADCAST_ROWS = 500_000


def _bounded(df: DataFrame) -> DataFrame:
    """A table of one number a row, broadcast only if a count finds at most BROADCAST_ROWS (some 8 MB); else the join shuffles."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _first_two(df: DataFrame, key: str) -> DataFrame:
    """One row for each `key`: `b1` its (id, repo, shared) of the least id and `b2` the least of a repository other than b1's."""
    rows = df.groupBy(key, "repo").agg(F.min(F.struct("id", "shared")).alias("b"))
    w = Window.partitionBy(key).orderBy("b", "repo")
    rows = rows.withColumn("rn", F.row_number().over(w)).where("rn <= 2").withColumn("b", F.struct("b.id", "repo", "b.shared"))
    return rows.groupBy(key).agg(*(F.max(F.when(F.col("rn") == k, F.col("b"))).alias(f"b{k}") for k in (1, 2)))


def line_copies(df: DataFrame, repo: Column, identifier: str = "id", text: str = "content", least_chars: int = 12, share: float = 0.8, only: DataFrame | None = None) -> DataFrame:
    """(id, source_id, containment): files of which another repository's file contains at least `share` of the distinct lines,
    with the least identifier of all such files.

    Lines are compared trimmed, those under `least_chars` characters are left out. Files of equal line sets are one class with
    its least identifiers in two repositories. Of m lines a source must have `share`, so it has one of any m - share * m + 1: a
    class is looked up by so many of its rarest lines, whatever files they stand in, and lines of a single class need no lookup.
    NULL texts and files without such lines match nothing. With `only` (ids) just those files are looked up, against all files.
    """
    lines = F.array_distinct(F.transform(F.filter(F.transform(F.split(F.col(text), "\n"), lambda x: F.trim(F.regexp_replace(x, "\\s+", " "))), lambda x: F.length(x) >= least_chars), lambda x: F.xxhash64(x)))
    sets = df.where(F.col(text).isNotNull()).select(F.col(identifier).alias("id"), F.xxhash64(F.coalesce(repo, F.lit(""))).alias("repo"), F.sort_array(lines).alias("lines")).where(F.size("lines") > 0)
    sets = sets.withColumn("k", F.struct(F.xxhash64("lines").alias("a"), F.xxhash64(F.lit(1), F.reverse("lines")).alias("b")))
    if only is None:
        sets = cut(sets)
        wanted = sets.select("k").distinct()
        members = sets.select("k", "id", "repo", F.size("lines").alias("shared"))
        flat = cut(sets.groupBy("k").agg(F.first("lines").alias("lines")).select("k", F.size("lines").alias("m"), F.explode("lines").alias("line")))
    else:  # of all files, only the lines that a file asked for has
        mine = cut(sets.join(_bounded(only.select(F.col(identifier).alias("id"))), "id", "left_semi"))
        wanted = mine.select("k").distinct()
        lines_asked = _bounded(cut(mine.select(F.explode("lines").alias("line")).distinct()))
        hits = sets.select("k", "id", "repo", F.size("lines").alias("m"), F.explode("lines").alias("line")).join(lines_asked, "line", "left_semi")
        hits = cut(hits.groupBy("k", "id", "repo", "m").agg(F.collect_list("line").alias("lines")))
        members = hits.select("k", "id", "repo", F.col("m").alias("shared"))
        flat = cut(hits.groupBy("k", "m").agg(F.first("lines").alias("lines")).select("k", "m", F.explode("lines").alias("line")))
    entries = cut(_first_two(members, "k"))
    common = cut(flat.join(flat.groupBy("line").agg(F.count("*").alias("df")).where("df >= 2"), "line"))
    # containment is rounded to four places
    need = F.ceil(F.col("m") * (share - 0.00005) - 1e-9).cast("int")
    classes = cut(common.groupBy("k", "m").agg(F.array_sort(F.collect_list(F.struct("df", "line"))).alias("c")).select("k", "m", need.alias("need"), F.col("c.line").alias("c")))
    asked = classes.join(wanted, "k", "left_semi").where(F.size("c") >= F.col("need")).select("k", "need", F.explode(F.slice("c", F.lit(1), F.size("c") - F.col("need") + 1)).alias("line"))
    others = common.select(F.col("k").alias("of"), F.col("m").alias("most"), "line")
    pairs = asked.join(others, "line").where((F.col("k") != F.col("of")) & (F.col("most") >= F.col("need"))).select("k", "of").distinct()
    both = pairs.join(classes, "k").join(classes.select(F.col("k").alias("of"), F.col("c").alias("theirs")), "of").select("k", "of", "need", F.size(F.array_intersect("c", "theirs")).alias("shared")).where("shared >= need")
    pool = both.select("k", "of", "shared").join(entries.withColumnRenamed("k", "of"), "of").select("k", "shared", F.explode(F.array("b1", "b2")).alias("e")).union(entries.where("b2 IS NOT NULL").select("k", F.col("b1.shared"), F.explode(F.array("b1", "b2"))))
    best = _first_two(pool.where("e IS NOT NULL").select("k", "e.id", "e.repo", "shared"), "k")
    members = members if only is None else mine.select("k", "id", "repo", F.size("lines").alias("shared"))
    found = members.join(best, "k").withColumn("b", F.when(F.col("b1.repo") != F.col("repo"), F.col("b1")).otherwise(F.col("b2")))
    return found.where("b IS NOT NULL").select("id", F.col("b.id").alias("source_id"), F.round(F.col("b.shared") / F.col("shared"), 4).alias("containment")).where(F.col("containment") >= share)


def marked_files(df: DataFrame, repo: Column, identifier: str = "id", path: str = "relative_path", text: str = "content", language: str = "language") -> DataFrame:
    """(id, origin) of the files with a plain mark, and of those with a weak one that another repository's file contains.

    NULL columns count as empty. Only the files with a weak mark are looked up in the index; where there are none it is not built.
    """
    m = cut(df.select(F.col(identifier).alias("id"), marks_column(F.col(path), F.col(text), F.col(language)).alias("m")).select("id", "m.origin", "m.weak").where("origin IS NOT NULL OR weak"))
    plain, weak = m.where("origin IS NOT NULL").select("id", "origin"), m.where("origin IS NULL").select("id")
    if weak.isEmpty():
        return plain
    copies = line_copies(df.withColumnRenamed(identifier, "id") if identifier != "id" else df, repo, "id", text, only=weak)
    return plain.unionByName(weak.join(copies.select("id").distinct(), "id", "left_semi").select("id", F.lit("vendored").alias("origin")))


def classify_files(df: DataFrame, repo: Column, identifier: str = "id", path: str = "relative_path", text: str = "content", language: str = "language") -> DataFrame:
    """(id, origin, source_id, containment) of all rows; origin is NULL for hand-written files, also where they resemble others."""
    m = df.select(F.col(identifier).alias("id"), marks_column(F.col(path), F.col(text), F.col(language)).alias("m")).select("id", "m.origin", "m.weak")
    out = m.join(line_copies(df, repo, identifier, text), "id", "left")
    return out.select("id", F.when(F.col("weak") & F.col("source_id").isNotNull(), "vendored").otherwise(F.col("origin")).alias("origin"), "source_id", "containment")
