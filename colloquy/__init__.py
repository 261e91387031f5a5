"""colloquy: conversation analytics on Spark.

Modules:
    functions.text        scalar text functions (Column -> Column)
    sources.banks         bank, training-file, feedback and item-matrix sources and sinks
    operators.intents     tokens, intent model, response ranking, entity match, confidence gate
    operators.keywords    contrastive keywords of confused intent pairs
    operators.answers     response choice by length preference and history
    operators.state       conversation state, sessions, slots, forms, sign-in, facts
    operators.paths       rule lookup, path conformance, next step
    operators.corpus      corpus assembly
    operators.recommend   fuzzy match, one-hot, pattern kNN, missing items
    operators.scan        running state split into chunks
    streaming.streams     Structured Streaming forms
    plans                 registered queries over the driver tables, with oracle SQL
"""

__version__ = "0.1.0"
