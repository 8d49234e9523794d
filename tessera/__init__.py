"""tessera: corpus preparation for language-model training, as Spark jobs.

Modules
-------
sources    readers, writers, schemas and fixture views over the input tables
functions  column expressions (arrays, chat rendering, byte-level text)
operators  DataFrame operators (gates, author audit, global order, batching,
           context fitting, statistics, tokenizer training and encoding)
plans      end-to-end compositions of the operators
streaming  Structured Streaming variants
"""

__version__ = "0.1.0"
