"""The mixture weights come from training documents alone."""

from __future__ import annotations

from batchwarden.llm import language_model


def test_held_out_texts_teach_nothing(spark):
    """Other texts in the held-out documents leave every training document's score as it was."""
    bodies = ["a b c d e f g h " * 5, "a c e g b d f h x", "h g f e d c b a a a"]

    def scores(held_text):
        rows = [(i, held_text if language_model.held_out(i) else bodies[i % 3]) for i in range(60)]
        made = language_model.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        return {r.doc_id: r.score for r in made if not r.held_out}

    one, two = scores("a b c d e f g h " * 5), scores("never seen anywhere q r s t")
    assert one and one == two
