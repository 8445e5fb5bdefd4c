"""Training-data operators over documents, pages and conversations.

Each module holds one operator with its own interface; ``queries.py`` derives
the registered query results from them. Nothing else in the library imports
this subpackage.
"""
