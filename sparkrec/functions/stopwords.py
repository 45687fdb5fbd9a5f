"""English stop words: Spark ML's default list (``StopWordsRemover``), read from its jar.

Reading the resource file avoids needing a JVM, so the oracle SQL can embed
the same list.  (The reference used another library's list; see D8.)
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile


@functools.lru_cache(maxsize=1)
def english() -> tuple[str, ...]:
    import pyspark

    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    if jars:
        with zipfile.ZipFile(jars[0]) as z:
            words = z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode("utf-8").split()
        return tuple(words)
    from pyspark.ml.feature import StopWordsRemover  # needs a running JVM

    return tuple(StopWordsRemover.loadDefaultStopWords("english"))
