"""All registered queries: name -> (Spark query, check SQL or None)."""

from turnloom.plans import chats, corpus, files, manifests, plugs, rollouts, scores, streams, tools, vocabulary

MODULES = (corpus, files, manifests, chats, tools, scores, vocabulary, rollouts, streams, plugs)
QUERIES = {name: pair for module in MODULES for name, pair in module.QUERIES.items()}
