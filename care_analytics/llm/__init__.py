"""Training-data operators over ``documents``, ``embeddings`` and ``conversations``.

One module per operator; ``queries`` registers one thin query for each.  Nothing
else in the library imports this subpackage.
"""
