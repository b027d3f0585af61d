"""spindle: full-text indexing and ranking as Spark DataFrame plans.

Subpackages: ``functions`` (tokenizer and scoring expressions),
``operators`` (index, ranking, evaluation, joins), ``sources`` (document
readers, index storage), ``plans`` (jobs and the registered queries),
``streaming`` (streaming add).
"""

__version__ = "0.1.0"
