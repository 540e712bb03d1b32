"""Operations on training text: filtering, deduplication, tokens, pages, chats.

Nothing else in the library imports this subpackage.
"""
