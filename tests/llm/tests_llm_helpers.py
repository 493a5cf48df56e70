from test_simhash import brute_components, brute_print


def brute_prints_components(texts):
    """Component id of every document, by comparing all pairs."""
    rows = [(d, brute_print(t)) for d, t in texts.items()]
    return dict(zip((d for d, _ in rows), brute_components(rows)))
