"""Main text of web pages by differencing each page with its nearest neighbours by URL.

Pages are put in one order of host and path.  Each is compared with the page before and the page after it of the
same host: their text lines are aligned by a longest common subsequence, and what both share is the site's
frame and goes.  A neighbour that shares most of the page's open text is a copy, not a sibling, and deletes nothing.

Markup goes first where it speaks: lines of menus, headers, footers, sidebars, notices, adverts, forms and comments
are deleted without a neighbour, and lines inside the page's article stay, as copied articles and quoted passages
are shared lines too.  A class name that marks the layout around the only article marks nothing.  Differencing decides about all
lines that are neither: on a page without an article, and on one whose article is a teaser, shorter than the other text that no
neighbour shares.  Such text then stays, with the teaser in its place.

Only the hashes of lines travel.  The order is cut into blocks of ``BLOCK`` pages, and each block also
sees the one page before and after it, so a host may hold any share of all pages.

Defined cases: null or empty html is an empty text.  A null or unparsable URL is a host of its own, the empty one.
Repeated rows count once as neighbours and are all returned.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starblend.llm.html_blocks import Block, blocks
from starblend.workspace import Workspace

BLOCK = 64
COPY_SHARE = 0.8
_URL = re.compile(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)")


def place(url: str | None) -> tuple[str, str]:
    """Host and path of a URL, the port, a default page name and a closing slash left out."""
    found = _URL.match(url or "")
    if not found:
        return "", ""
    host = found[1].rpartition("@")[2].lower().partition(":")[0]
    return host, re.sub(r"/(?:(?:index|default)\.\w+)?$", "", found[2])


def common_lines(a: list, b: list) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    where = defaultdict(list)
    for j in range(len(b) - tail - 1, head - 1, -1):
        where[b[j]].append(j)
    ends: list[int] = []  # least last position in b of a common subsequence of each length
    last: list[tuple] = []
    for i in range(head, len(a) - tail):
        for j in where.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, last[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                last.append(link)
            else:
                ends[k], last[k] = j, link
    middle = []
    link = last[-1] if last else None
    while link is not None:
        middle.append(link[0])
        link = link[1]
    return [*range(head), *reversed(middle), *range(len(a) - tail, len(a))]


def _open(block: Block) -> bool:
    return not block.chrome and not block.main


def deleted(lines: list[int], weights: list[int], neighbours: list[list[int]]) -> list[int]:
    """Positions of open lines shared with a neighbour that is no copy; ``weights`` are 0 for lines that are not open."""
    total, out = sum(weights), set()
    for other in neighbours:
        shared = common_lines(lines, other)
        if sum(weights[i] for i in shared) < COPY_SHARE * total:
            out.update(i for i in shared if weights[i])
    return sorted(out)


def article_lines(page: list[Block]) -> list[bool]:
    """Which blocks are the page's article: those in an article that stands free, else those in one inside a marked layout."""
    main = [b.main and not b.chrome for b in page]
    free = [m and not b.wrapped for m, b in zip(main, page, strict=True)]
    return free if any(free) else main


def article(page: list[Block]) -> str | None:
    """The lines of the page's article; None where no article is marked."""
    return "\n".join(b.text for b, m in zip(page, article_lines(page), strict=True) if m) or None


PARSED = """page_id long, url string, id_key long, key long, host string, path string,
shown array<string>, main array<boolean>, lines array<long>, weights array<int>"""


def _parse(pages: DataFrame, work: Workspace) -> DataFrame:
    """Each page's place and lines; ``shown`` has those of its article (``main``) and those that differencing decides about.

    ``weights`` are the lengths of the latter, on every page.
    """

    def parse(batches):
        for batch in batches:
            rows = []
            for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
                page = blocks(html)
                main = article_lines(page)
                shown = [b.text if m or _open(b) else "" for b, m in zip(page, main, strict=True)]
                weights = [0 if m else len(t) for t, m in zip(shown, main, strict=True)]
                rows.append((*place(url), shown, main, [xxhash.xxh64_intdigest(f"{b.path}\n{b.text}") - 2**63 for b in page], weights))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.string()] * 2 + [pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("page_id", "url", "id_key", "key")]
                + [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                names=["page_id", "url", "id_key", "key", "host", "path", "shown", "main", "lines", "weights"],
            )

    return work.table(pages.mapInArrow(parse, PARSED), "parsed")


def _deletions(parsed: DataFrame, work: Workspace) -> DataFrame:
    """``id_key, key, gone`` of the pages that lose open lines to a neighbour."""
    order = ["host", "path", "id_key", "key"]
    # a page is compared within its host only, so hosts without a line to decide about send nothing
    asking = parsed.where(F.exists("weights", lambda w: w > 0)).select("host").distinct()
    asked = parsed.select(*order, "lines", "weights").join(asking, "host", "left_semi")
    ordered = asked.select(*order, "lines", "weights").repartitionByRange(*order).sortWithinPartitions(*order)
    staged = work.table(ordered.withColumn("_place", F.monotonically_increasing_id()), "lines")
    part = F.shiftright("_place", 33)
    sizes = staged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = staged.withColumn("part", part).join(firsts, "part").withColumn(
        "rank", F.col("first") + F.col("_place").bitwiseAND(F.lit(2**33 - 1))
    )
    block, at = F.floor(F.col("rank") / BLOCK), F.pmod("rank", F.lit(BLOCK))
    seen_by = F.array_compact(F.array(block, F.when(at == 0, block - 1), F.when(at == BLOCK - 1, block + 1)))
    dealt = ranked.select(*order, "lines", "weights", "rank", block.alias("own"), F.explode(seen_by).alias("block"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        rows = list(frame.sort_values("rank").itertuples())
        kept = [row for i, row in enumerate(rows) if not i or (row.id_key, row.key) != (rows[i - 1].id_key, rows[i - 1].key)]
        out = []
        for i, row in enumerate(kept):
            if row.own != row.block or not np.any(row.weights):
                continue
            near = [list(o.lines) for o in kept[max(0, i - 1) : i + 2] if o is not row and o.host == row.host and o.host]
            gone = deleted(list(row.lines), list(row.weights), near)
            if gone:
                out.append((row.id_key, row.key, gone))
        return pd.DataFrame(out, columns=["id_key", "key", "gone"])

    found = dealt.groupBy("block").applyInPandas(compare, "id_key long, key long, gone array<int>")
    return work.table(found.dropDuplicates(["id_key", "key"]), "deleted")


def extract(pages: DataFrame, work: Workspace) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id, url, html``)."""
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html",
        F.coalesce(F.col("page_id").cast("long"), F.lit(-1)).alias("id_key"), F.xxhash64("page_id", "url", "html").alias("key"),
    )
    parsed = _parse(keyed, work)
    joined = parsed.join(_deletions(parsed, work), ["id_key", "key"], "left")
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    left = F.filter("shown", lambda line, i: (line != "") & ~F.array_contains(gone, i))
    own = F.filter("shown", lambda line, i: (line != "") & F.get("main", i))

    def length(lines):
        return F.length(F.array_join(lines, ""))

    # an article at least as long as the other text that is left is the page's text alone
    text = F.array_join(F.when((F.size(own) > 0) & (2 * length(own) >= length(left)), own).otherwise(left), "\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
