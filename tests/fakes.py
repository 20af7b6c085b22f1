"""Services that the command line is given in tests; what they know is in a file named by FAKE_SERVICE."""

import json
import os

from folioflow.operators import classifier
from folioflow.sources import remote
from pyspark.sql import functions as F


class Service(remote.MemoryTransport):
    """Search index, files and library in one; a URL's last part is the text of its file."""

    def __init__(self):
        with open(os.environ["FAKE_SERVICE"]) as held:
            told = json.load(held)
        super().__init__(told["records"])
        self.texts = told["texts"]
        self.library = remote.MemoryTransport([{"bibcode": b} for b in told["library"]])

    def get(self, url):
        text = self.texts.get(url.rpartition("/")[2])
        return (404, {}, b"", url) if text is None else (200, {"content-type": "application/pdf"}, b"%PDF-1.7 " + text.encode(), url)


def extract(rows):
    """Pages are parted by form feeds; the word `broken` makes a file unreadable."""
    text = F.regexp_replace(F.decode("content", "ISO-8859-1"), r"%PDF-1.7 ?", "")
    page = rows.select("id", F.posexplode(F.split(text, "\f")).alias("page", "text"))
    bad = F.col("text").contains("broken")
    return page.select("id", (F.col("page") + 1).alias("page"), F.when(~bad, F.col("text")).alias("text"), F.when(bad, "cannot open broken document").alias("error"))


class Refusing(classifier.TermClassifier):
    """Knows no model at all."""

    def __init__(self, model, effort):
        super().__init__()
        self.model = model

    def check(self):
        raise classifier.ServiceError(f"no such model: {self.model}", "not_found")


class Named(classifier.TermClassifier):
    def __init__(self, model, effort):
        super().__init__()
        self.told = {"model": f"{model}-{effort}"}

    def decide(self, pages):
        return super().decide(pages) | {"response": self.told}
