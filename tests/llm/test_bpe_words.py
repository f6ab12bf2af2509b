"""The memo of words."""

import struct

import public_tokenizers
import tokenizers

from tidemark.llm import bpe


def test_a_word_is_encoded_once_whatever_stands_beside_it():
    tool = bpe.Codec(public_tokenizers.path("byte_bpe_50k.json"))
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    asked = []
    plain = tool.encode_piece
    tool.encode_piece = lambda piece: asked.append(piece) or plain(piece)
    text = "start quinxel quinxel. quinxel,\nquinxel quinxel### don't 'quinxel' quinxel.\n\nquinxel's été! été. 12 12% end"
    tool.encode(text)
    once = [asked.count(piece) for piece in (" quinxel", " été".encode().decode("latin-1"), ".", "###")]
    for whole in (text, text.replace(" 12", "  12 \n") + " "):
        ids = struct.unpack(f"<{len(tool.encode(whole)) // 4}I", tool.encode(whole))
        assert list(ids) == library.encode(whole, add_special_tokens=False).ids
    assert once == [1, 1, 1, 1]
