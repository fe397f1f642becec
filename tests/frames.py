"""Small hand-made tables with the types of the real ones."""

from paperloom.schemas import CONCEPTS, TOPICS

WORKS = (
    "id string, doi string, publication_year int, cited_by_count int, "
    "authorships array<struct<author_position: string>>, abstract_inverted_index string, "
    f"topics {TOPICS}, concepts {CONCEPTS}"
)
PAPERS = (
    "corpusid bigint, externalids struct<DOI: string, ArXiv: string>, venue string, year bigint, "
    "s2fieldsofstudy array<struct<category: string, source: string>>, "
    "has_abstract boolean, has_fulltext boolean"
)
FULLTEXT = (
    "corpusid bigint, "
    "body struct<text: string, annotations: array<struct<start: bigint, end: bigint>>>"
)


def topic(n, subfield=None):
    pair = lambda kind: (f"{kind}{n}", f"{kind} {n}")
    return (*pair("T"), (f"S{n}", subfield or f"S {n}"), pair("F"), pair("D"), 0.5)


def work(id, doi="https://doi.org/10.1/a", year=2000, cited=None, authors=None, abstract=None,
         topics=None, concepts=None):
    authorships = None if authors is None else [(str(i),) for i in range(authors)]
    if isinstance(topics, int):
        topics = [topic(n) for n in range(topics)]
    return (id, doi, year, cited, authorships, abstract, topics, concepts)


def works(spark, *rows):
    return spark.createDataFrame(list(rows), WORKS)


def paper(corpusid, doi=None, arxiv=None, venue=None, year=2000, fields=None, abstract=None,
          fulltext=None):
    return (corpusid, (doi, arxiv), venue, year, fields, abstract, fulltext)


def papers(spark, *rows):
    return spark.createDataFrame(list(rows), PAPERS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plan(df):
    """Text of the physical plan with full scan details."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
