"""Listings and links of the given pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseledger.operators.harvest import follow, walk_listing
from caseledger.queries.base import query

_HREFS = """SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages"""


def _hrefs(t):
    return t("pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))).alias("href"))


@query(f"""WITH RECURSIVE e AS (SELECT DISTINCT page_id % 7 AS site, (page_id // 7) % 23 AS page, href AS detail FROM ({_HREFS})),
w AS (SELECT site, -1::BIGINT AS page, []::VARCHAR[] AS seen, []::VARCHAR[] AS fresh FROM (SELECT DISTINCT site FROM e)
 UNION ALL SELECT w.site, w.page + 1, list_concat(w.seen, f.fresh), f.fresh FROM w, LATERAL (SELECT coalesce(list(detail), []) AS fresh FROM e WHERE e.site = w.site AND e.page = w.page + 1 AND NOT list_contains(w.seen, detail)) f WHERE w.page + 1 < 20 AND len(f.fresh) > 0)
SELECT site, unnest(fresh) AS detail, page FROM w""")
def listing_walk(spark, t):
    """Pages read as the numbered listings of seven sites, their links as what they list."""
    e = _hrefs(t).select((F.col("page_id") % 7).alias("site"), (F.floor(F.col("page_id") / 7) % 23).alias("page"), F.col("href").alias("detail"))
    return walk_listing(e, "site", "page", "detail")


@query(f"""WITH RECURSIVE h AS (SELECT DISTINCT page_id, href FROM ({_HREFS})), e AS (SELECT DISTINCT a.page_id AS a, b.page_id AS b FROM h a JOIN h b USING (href) WHERE a.page_id <> b.page_id),
w AS (SELECT 0::BIGINT AS node, 0 AS round UNION SELECT e.b, w.round + 1 FROM w JOIN e ON e.a = w.node WHERE w.round < 6)
SELECT node, min(round)::INTEGER AS round FROM w GROUP BY 1""")
def linked_pages(spark, t):
    """What is reached from the first page over links that two pages share: links and pages take turns, so the shared ones
    are never expanded into pairs; pages stand in even rounds."""
    h = _hrefs(t).distinct()
    page, link = F.concat(F.lit("p"), F.col("page_id").cast("string")), F.concat(F.lit("h"), F.col("href"))
    edges = h.select(page.alias("a"), link.alias("b")).unionByName(h.select(link.alias("a"), page.alias("b")))
    found = follow(spark.createDataFrame([("p0",)], "node string"), edges, "a", "b", rounds=12).filter("node like 'p%'")
    return found.select(F.substring("node", 2, 20).cast("long").alias("node"), (F.col("round") / 2).cast("int").alias("round"))


# One page a nation: a table under each customer segment's year heading, or one table with year rows, by the nation's parity.
_ROW = """'<tr><td>' || c_custkey || '</td><td>' || c_name || '</td><td>' || CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '<a href="/node/' || c_custkey % 40 || '">see</a>' ELSE '<a href="/f/' || c_custkey || '.PDF">one</a>' || CASE WHEN c_custkey % 4 = 3 THEN ' <a href="/f/' || c_custkey || '-b.pdf">two</a>' ELSE '' END END || '</td></tr>'"""
_YEAR = "CAST(2010 + length(c_mktsegment) AS VARCHAR(9))"


def _index_pages(t):
    c = t("customer").select("c_nationkey", "c_custkey", F.expr(_YEAR).alias("year"), F.expr(_ROW).alias("tr"))
    head = "<tr><th>Date Occurred</th><th>x</th></tr>"
    years = c.groupBy("c_nationkey", "year").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "tr"))), lambda x: x["tr"]), "").alias("trs"))
    odd = F.col("c_nationkey") % 2 == 1
    part = F.when(odd, F.concat(F.lit("<tr><td> "), F.col("year"), F.lit("</td></tr>"), F.col("trs"))).otherwise(F.concat(F.lit("<h2>"), F.col("year"), F.lit(f"</h2><table>{head}"), F.col("trs"), F.lit("</table>")))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("year", part.alias("p")))), lambda x: x["p"]), "")
    pages = years.groupBy("c_nationkey").agg(body.alias("b"))
    table = F.when(odd, F.concat(F.lit(f"<h3>Older</h3><table>{head}"), F.col("b"), F.lit("</table>"))).otherwise(F.concat(F.col("b"), F.lit("<h2>Notes</h2><table><tr><td>n</td><td>no&nbsp;year</td></tr></table>")))
    return pages.select("c_nationkey", F.concat(F.lit("<h2>2001</h2><main>"), table, F.lit("</main><table><tr><td>out</td><td>side</td></tr></table>")).alias("html"))


_INDEX = f"WITH c AS (SELECT *, {_YEAR} AS year, row_number() OVER (PARTITION BY c_nationkey ORDER BY {_YEAR}, c_custkey)::INTEGER - 1 AS row FROM customer)"


@query(_INDEX + """, h AS (SELECT c_nationkey, row, year, '' AS detail, unnest(range(0, CASE c_custkey % 4 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE 0 END)) AS place, c_custkey FROM c),
d AS (SELECT c_nationkey, row, year, 'https://site.example/node/' || c_custkey % 40 AS detail, unnest(range(0, (c_custkey % 40 % 3))) AS place, c_custkey % 40 AS k FROM c WHERE c_custkey % 4 = 1)
SELECT c_nationkey, row, year, detail, place::INTEGER AS place, '/f/' || c_custkey || CASE place WHEN 0 THEN '.PDF' ELSE '-b.pdf' END AS href FROM h UNION ALL SELECT c_nationkey, row, year, detail, place::INTEGER, '/d/' || k || '-' || place || '.pdf' FROM d""")
def report_index(spark, t):
    """Report links of both index layouts, with their years, those of detail pages among them."""
    from caseledger.sources.html import report_links, report_rows

    rows = report_rows(_index_pages(t), "c_nationkey", "html")
    n = F.col("c_custkey") % 40
    hrefs = F.transform(F.sequence(F.lit(0), n % 3), lambda i: F.when(i < n % 3, F.concat(F.lit("/d/"), n.cast("string"), F.lit("-"), i.cast("string"), F.lit(".pdf"))).otherwise("/about"))
    details = t("customer").select(F.concat(F.lit("https://site.example/node/"), n.cast("string")).alias("url"), hrefs.alias("hrefs")).distinct()
    return report_links(rows, "c_nationkey", details, "url", "https://site.example")


@query(_INDEX + """ SELECT c_nationkey, row, c_custkey || '|' || c_name || '|' AS cells FROM c WHERE c_custkey % 4 = 0
UNION ALL SELECT c_nationkey, max(row) + 1, 'n|no year' FROM c WHERE c_nationkey % 2 = 0 GROUP BY 1""")
def report_unlinked(spark, t):
    """Rows of the index pages that link to nothing."""
    from caseledger.sources.html import report_rows, unlinked_rows

    return unlinked_rows(report_rows(_index_pages(t), "c_nationkey", "html"), "c_nationkey").select("c_nationkey", "row", F.array_join("cells", "|").alias("cells"))
