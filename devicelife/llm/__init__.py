"""Training-data operators: one module per operator, plus the registered
queries (:mod:`devicelife.llm.queries`). Nothing else in the package imports
this subpackage."""
