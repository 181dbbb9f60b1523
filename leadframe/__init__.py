"""Lead and web-page analytics as Spark DataFrame operators.

Layout
------
functions   column expressions: text, HTML, URLs, payloads, ordered rules
operators   DataFrame -> DataFrame building blocks (titles, pages, CRM, crawl)
sources     readers and writers for the file layouts the tool exchanges
streaming   incremental runs on Structured Streaming
plans       the registered queries and their SQL twins
"""

__version__ = "0.1.0"
