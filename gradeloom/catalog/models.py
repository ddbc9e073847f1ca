"""A small rule that stands in for an embedding model and has a form in SQL."""


def letter_profile():
    """A factory: a text's share of each letter from a to z."""

    def factory():
        def vector(text):
            counts = [text.count(chr(97 + k)) for k in range(26)]
            total = float(sum(counts)) or 1.0
            return [count / total for count in counts]

        return lambda texts: [vector(text) for text in texts]

    return factory
