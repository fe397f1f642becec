"""Works, papers, abstracts and full texts derived from the given tables.

Every document is one work and one paper; exact copies of a text share a DOI. NULLs, empty
lists, out-of-range years and upper-case DOIs hang on the source or language of a document.
`Tables` derives them in Spark, `SQL` states the same tables for the comparison.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.schemas import TOPIC, TOPICS

# Columns of the given tables read here; declaring them saves a job that reads a footer.
_GIVEN = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}

# Lists of 0 to 3 entries numbered from 0.
_NUMBERED = "slice(array(0, 1, 2), 1, CAST({n} AS INT))"

_TOPIC = """named_struct(
    'id', concat('T', (doc_id + i) % 40),
    'display_name', concat('topic ', (doc_id + i) % 40),
    'subfield', named_struct('id', concat('S', (doc_id + i) % 14),
                             'display_name', concat('subfield ', (doc_id + i) % 14)),
    'field', named_struct('id', concat('F', (doc_id + i) % 7),
                          'display_name', concat('field ', (doc_id + i) % 7)),
    'domain', named_struct('id', concat('D', (doc_id + i) % 2),
                           'display_name', concat('domain ', (doc_id + i) % 2)),
    'score', CAST(0.5 AS DOUBLE))"""

_WORKS = [
    "concat('W', doc_id) AS id",
    "CASE WHEN source <> 'src9' THEN concat('https://doi.org/10.1/', md5(text)) END AS doi",
    "CASE WHEN source <> 'src15' THEN CAST(1890 + doc_id % 140 AS INT) END AS publication_year",
    "CAST(quality * 10 + toxic AS INT) AS cited_by_count",
    f"""CASE WHEN source <> 'src6' THEN transform({_NUMBERED.format(n='doc_id % 4')},
        i -> named_struct('author_position', CAST(i AS STRING))) END AS authorships""",
    "CASE WHEN lang <> 'de' THEN text END AS abstract_inverted_index",
    f"""CASE WHEN source <> 'src7' THEN transform({_NUMBERED.format(n='doc_id % 3')},
        i -> {_TOPIC}) END AS topics""",
    f"""CASE WHEN source <> 'src17' THEN transform({_NUMBERED.format(n='doc_id % 2')},
        i -> named_struct('id', concat('C', doc_id % 30), 'wikidata', CAST(NULL AS STRING),
                          'display_name', concat('concept ', doc_id % 30),
                          'level', CAST(i AS BIGINT), 'score', CAST(0.25 AS DOUBLE)))
        END AS concepts""",
]

_PAPERS = [
    "doc_id AS corpusid",
    """named_struct(
        'DOI', CASE WHEN source = 'src5' THEN NULL
                    WHEN source = 'src13' THEN concat('10.1/', upper(md5(text)))
                    ELSE concat('10.1/', md5(text)) END,
        'ArXiv', CASE WHEN source <> 'src10' THEN concat('ax', doc_id) END) AS externalids""",
    """CASE WHEN source = 'src11' THEN NULL WHEN source = 'src12' THEN ''
            ELSE source END AS venue""",
    "CASE WHEN source <> 'src3' THEN CAST(1890 + doc_id % 140 AS BIGINT) END AS year",
    """CASE WHEN source = 'src8' THEN NULL
            WHEN source = 'src1' THEN array(named_struct('category', lang, 'source', 'external'))
            ELSE array(named_struct('category', 'x', 'source', 'external'),
                       named_struct('category', CASE WHEN source <> 'src17' THEN lang END,
                                    'source', 's2-fos-model'),
                       named_struct('category', 'zz', 'source', 's2-fos-model'))
            END AS s2fieldsofstudy""",
]

# State before an incremental run: some flags decided, some topics filled.
_PRIOR = [
    "doc_id AS corpusid",
    "CASE lang WHEN 'fr' THEN TRUE WHEN 'de' THEN FALSE END AS has_abstract",
    "CASE lang WHEN 'fr' THEN FALSE WHEN 'es' THEN TRUE END AS has_fulltext",
    f"""CASE WHEN source IN ('src0', 'src4', 'src10')
        THEN from_json('[{{"id": "old"}}]', '{TOPICS}') END AS oa_topics""",
    f"""CASE WHEN source IN ('src0', 'src4', 'src10')
        THEN from_json('{{"id": "old"}}', '{TOPIC}') END AS oa_primary_topic""",
]

_FULLTEXT = [
    "doc_id AS corpusid",
    """named_struct(
        'text', CASE lang WHEN 'es' THEN '' WHEN 'de' THEN NULL ELSE text END,
        'annotations', array(named_struct('start', CAST(0 AS BIGINT), 'end', n_chars))) AS body""",
]


class Tables:
    """The derived tables of one data folder, built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def given(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in _GIVEN:
            reader = reader.schema(_GIVEN[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def works(self) -> DataFrame:
        documents, labels = self.given("documents"), self.given("labels")
        return documents.join(labels, "doc_id", "left").selectExpr(*_WORKS)

    @cached_property
    def papers(self) -> DataFrame:
        return self.given("documents").selectExpr(*_PAPERS)

    @cached_property
    def papers_prior(self) -> DataFrame:
        return self.given("documents").selectExpr(*_PRIOR)

    @cached_property
    def abstracts(self) -> DataFrame:
        labels = self.given("labels")
        good = labels.filter(F.col("quality") == 1)
        return labels.unionAll(good).select(F.col("doc_id").alias("corpusid"))

    @cached_property
    def fulltext(self) -> DataFrame:
        return self.given("documents").filter("source NOT IN ('src2', 'src14')").selectExpr(*_FULLTEXT)


# ---- the same tables in SQL ----------------------------------------------------------------

_SQL_TOPIC = """{'id': 'T' || CAST((d.doc_id + i) % 40 AS VARCHAR),
      'display_name': 'topic ' || CAST((d.doc_id + i) % 40 AS VARCHAR),
      'subfield': {'id': 'S' || CAST((d.doc_id + i) % 14 AS VARCHAR),
                   'display_name': 'subfield ' || CAST((d.doc_id + i) % 14 AS VARCHAR)},
      'field': {'id': 'F' || CAST((d.doc_id + i) % 7 AS VARCHAR),
                'display_name': 'field ' || CAST((d.doc_id + i) % 7 AS VARCHAR)},
      'domain': {'id': 'D' || CAST((d.doc_id + i) % 2 AS VARCHAR),
                 'display_name': 'domain ' || CAST((d.doc_id + i) % 2 AS VARCHAR)},
      'score': CAST(0.5 AS DOUBLE)}"""

SQL = {
    "works": f"""
  SELECT 'W' || d.doc_id AS id,
    CASE WHEN d.source <> 'src9' THEN 'https://doi.org/10.1/' || md5(d.text) END AS doi,
    CASE WHEN d.source <> 'src15' THEN CAST(1890 + d.doc_id % 140 AS INTEGER) END
      AS publication_year,
    CAST(l.quality * 10 + l.toxic AS INTEGER) AS cited_by_count,
    CASE WHEN d.source <> 'src6' THEN list_transform(range(d.doc_id % 4),
      lambda i: {{'author_position': CAST(i AS VARCHAR)}}) END AS authorships,
    CASE WHEN d.lang <> 'de' THEN d.text END AS abstract_inverted_index,
    CASE WHEN d.source <> 'src7' THEN list_transform(range(d.doc_id % 3),
      lambda i: {_SQL_TOPIC}) END AS topics,
    CASE WHEN d.source <> 'src17' THEN list_transform(range(d.doc_id % 2),
      lambda i: {{'id': 'C' || CAST(d.doc_id % 30 AS VARCHAR), 'level': CAST(i AS BIGINT)}})
      END AS concepts
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "papers": """
  SELECT d.doc_id AS corpusid,
    {'DOI': CASE WHEN d.source = 'src5' THEN NULL
                 WHEN d.source = 'src13' THEN '10.1/' || upper(md5(d.text))
                 ELSE '10.1/' || md5(d.text) END,
     'ArXiv': CASE WHEN d.source <> 'src10' THEN 'ax' || d.doc_id END} AS externalids,
    CASE WHEN d.source = 'src11' THEN NULL WHEN d.source = 'src12' THEN ''
         ELSE d.source END AS venue,
    CASE WHEN d.source <> 'src3' THEN CAST(1890 + d.doc_id % 140 AS BIGINT) END AS year,
    CASE WHEN d.source = 'src8' THEN NULL
         WHEN d.source = 'src1' THEN [{'category': d.lang, 'source': 'external'}]
         ELSE [{'category': 'x', 'source': 'external'},
               {'category': CASE WHEN d.source <> 'src17' THEN d.lang END,
                'source': 's2-fos-model'},
               {'category': 'zz', 'source': 's2-fos-model'}] END AS s2fieldsofstudy
  FROM documents d""",
    "papers_prior": """
  SELECT doc_id AS corpusid,
    CASE lang WHEN 'fr' THEN TRUE WHEN 'de' THEN FALSE END AS has_abstract,
    CASE lang WHEN 'fr' THEN FALSE WHEN 'es' THEN TRUE END AS has_fulltext,
    CASE WHEN source IN ('src0', 'src4', 'src10') THEN 'old' END AS old_topic
  FROM documents""",
    "abstracts": """
  SELECT doc_id AS corpusid FROM labels
  UNION ALL SELECT doc_id FROM labels WHERE quality = 1""",
    "fulltext": """
  SELECT doc_id AS corpusid,
    {'text': CASE lang WHEN 'es' THEN '' WHEN 'de' THEN NULL ELSE text END,
     'annotations': [{'start': CAST(0 AS BIGINT), 'end': n_chars}]} AS body
  FROM documents WHERE source NOT IN ('src2', 'src14')""",
    "deduped": """
  SELECT best.* FROM (
    SELECT arg_min(works, {
      'a': -coalesce(cited_by_count, -1), 'b': -coalesce(len(authorships), -1),
      'c': abstract_inverted_index IS NULL, 'd': -coalesce(len(topics), -1),
      'e': id IS NULL, 'f': coalesce(id, '')}) AS best
    FROM works WHERE doi IS NOT NULL GROUP BY doi)
  WHERE best.id IS NOT NULL""",
    "lookup": """
  SELECT CAST(p.corpusid AS INTEGER) AS corpusid, w.id AS oa_id,
    CAST(w.publication_year AS SMALLINT) AS publication_year
  FROM papers p JOIN deduped w
    ON p.externalids.DOI = replace(w.doi, 'https://doi.org/', '')
  WHERE p.externalids.DOI IS NOT NULL AND w.doi IS NOT NULL
    AND w.publication_year BETWEEN 1900 AND 2025""",
    "flagged": """
  SELECT p.*, p.corpusid IN (SELECT corpusid FROM abstracts) AS has_abstract,
    p.corpusid IN (SELECT corpusid FROM fulltext) AS has_fulltext
  FROM papers p""",
    "topic_match": """
  SELECT corpusid, topics, concepts FROM (
    SELECT k.corpusid, w.topics, w.concepts,
      row_number() OVER (PARTITION BY k.corpusid ORDER BY w.id) AS rn
    FROM lookup k JOIN works w ON k.oa_id = w.id) WHERE rn = 1""",
    "topic_counts": """
  SELECT publication_year, t.display_name AS topic_name, t.subfield.display_name AS subfield_name,
    t.field.display_name AS field_name, t.domain.display_name AS domain_name, num_papers
  FROM (SELECT publication_year, first_topic AS t, count(*) AS num_papers
    FROM (SELECT publication_year, list_extract(topics, 1) AS first_topic FROM works)
    GROUP BY publication_year, first_topic)""",
}

_NEEDS = {
    "deduped": ["works"],
    "lookup": ["papers", "deduped"],
    "flagged": ["papers", "abstracts", "fulltext"],
    "topic_match": ["lookup", "works"],
    "topic_counts": ["works"],
    "field_counts": ["flagged"],
    "venue_counts": ["flagged"],
    "corpus": ["flagged", "fulltext"],
}


def _metric_sql(group: str, expression: str) -> str:
    """The long metric rows: one conditional aggregate, turned by UNPIVOT."""
    return f"""
  SELECT {group}, year, metric_type, count FROM (
    UNPIVOT (
      SELECT {expression} AS {group}, year, sum(1) AS total,
        sum(CASE WHEN has_abstract THEN 1 ELSE 0 END) AS has_abstract,
        sum(CASE WHEN has_fulltext THEN 1 ELSE 0 END) AS has_fulltext
      FROM flagged WHERE year >= 1900 AND year <= 2025 GROUP BY 1, 2)
    ON total, has_abstract, has_fulltext INTO NAME metric_type VALUE wide)
  CROSS JOIN LATERAL (SELECT CAST(wide AS BIGINT) AS count)
  WHERE {group} IS NOT NULL AND wide > 0"""


SQL["field_counts"] = _metric_sql(
    "field", "list_filter(s2fieldsofstudy, lambda x: x.source = 's2-fos-model')[1].category"
)
SQL["venue_counts"] = _metric_sql("venue", "venue")
SQL["corpus"] = """
  SELECT p.corpusid, CAST(p.year AS INTEGER) AS year, p.externalids.ArXiv AS arxiv_id,
    f.body.text AS text, CAST(to_json(f.body.annotations) AS VARCHAR) AS annotations,
    length(f.body.text) AS text_length
  FROM flagged p JOIN fulltext f ON p.corpusid = f.corpusid
  WHERE p.externalids.ArXiv IS NOT NULL AND p.has_fulltext
    AND f.body.text IS NOT NULL AND f.body.text <> ''"""


def with_tables(*names: str, query: str) -> str:
    """`query` behind the definitions of the tables it uses, in order of dependence."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    definitions = ",\n".join(f"{name} AS ({SQL[name]})" for name in ordered)
    return f"WITH {definitions}\n{query}"
