"""Digests of whole licence texts and their titles, as license_texts.py prints them."""

DIGESTS = [
    ("0BSD", "0fa3226b19b31763cb8173b8ae9443e9b63a44156b1249c2cfce561c4e283fe9"),
    ("0BSD", "1174dda35c9469d58da21006501de777afb0a9b7e6f094417f96885cfa1c941c"),
    ("0BSD", "135f996b0799264a94667b307181b4e708ac75af3dd183e62a37bd0555cbf0cc"),
    ("0BSD", "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c"),
    ("0BSD", "3d7b7ce2a6e224f3ce2c959b8b26ed63938ae9ac89a1a93812c66acfe9971516"),
    ("0BSD", "53695ed162cb0132fe0563719addeac105c8cad72350fae9183e2c74a7c0dbbe"),
    ("0BSD", "79c3eba6d1eeea5eb0e9b4b77d34534c7f4ccef87ecebbc336447459197e75b9"),
    ("0BSD", "9c842909bcc85365ba7f0d106fccdc3af51784431076174588a9832837ebf153"),
    ("0BSD", "ceed880b6ef60bae3850b451371993ecefb718aa2d1d9976f36e2e5d7199c391"),
    ("Apache-2.0", "5d95b26a4ccbffa4e2f81b2b00c4ff5134c49e2f4ade8f484b022a4a17a6421d"),
    ("Apache-2.0", "75b3d8f3dc3be07ba9953087b00e25ecc5535e98f64bf37aac993d74c498789c"),
    ("Apache-2.0", "7ba14cacf20ca7e603ad62f6e32ee66b25ef98f0783a57d8355d6a9fa372e7d3"),
    ("Apache-2.0", "91deb36dc666c7fb63a727baae28d57698809f5f34e1fe0ca1d40170b1d19c8f"),
    ("Apache-2.0", "d1bd170d955a0fd5f372bcc8cd4a1d23b51e737c395612755dc51ecf7eba63a1"),
    ("Apache-2.0", "f370487159885bc9b48760fc11b3496390b1db79ae837254163623a0e17292b2"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("Artistic-1.0-Perl", "4eaaa9e33aeef0af0ff83ab5edac0ad421a1da9cc861c564630460107b4b772c"),
    ("BSD-2-Clause", "22a603ae7ca12ed32433ab981867da4735f74eae59e3da680b1fae36412f6288"),
    ("BSD-2-Clause", "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2"),
    ("BSD-2-Clause", "3938f828c79910468f483f925e6a33217162693f71035d6044cbd04dc6fd1bd5"),
    ("BSD-2-Clause", "4267bc0bac39cefa2d86a392b7e4501fe1c95a6c95b0f0fa3dff4ddbea206532"),
    ("BSD-2-Clause", "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2"),
    ("BSD-2-Clause", "4a5b45ed3ca9ae854c5505a774b3659d3852be9a3412b822802b3cdbe5dc7b0a"),
    ("BSD-2-Clause", "5d123f3d2076a6b22f7b17a92623627ef50d1584e8cf13b7d4040f1c6e8a0424"),
    ("BSD-2-Clause", "6ff79a5418e8962b26f9f5e4cf926655817d9bf541f5c5a28a04f8579b5c8247"),
    ("BSD-2-Clause", "7412f7ee502b0e1eddedab2fd96afa36a9b61c563743d2d8318ad5e460bc3264"),
    ("BSD-2-Clause", "757641796f5809a5392a06e2ef8ece61190856ca9b6456d50797d190a665d54b"),
    ("BSD-2-Clause", "8b28f63734bf310903015ecd26ae5c979f31743ca170703b95426d7203774453"),
    ("BSD-2-Clause", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-2-Clause", "abaab61dfcb77e8cb9567fabeb2078dad30d3a23ee9904c0e5ce9a3df98f41e6"),
    ("BSD-2-Clause", "add68477e31f4c39352b96a5ed22128c47aa7c46de62e8bac51e8b390c6b215c"),
    ("BSD-2-Clause", "b265945940ccdc41492a8c56728fe75bfaf767b67d176e33b2649c7dcf426893"),
    ("BSD-2-Clause", "b7d49d651647319f38c254df78d020e1c773cbac121d97b17eb70bf3149e7233"),
    ("BSD-2-Clause", "c201888b652cbca1e8cedbbabc7f713c6af0672f5a642f7202c8728b082093e7"),
    ("BSD-2-Clause", "c5cb44b340dfa97436d18371e401686dddf3451388afa1a24c0e410cd7a38b24"),
    ("BSD-2-Clause", "d873404919cbc71e0a715d0f2bd267ca90c83465f70b71f472cd8bdf28e56585"),
    ("BSD-2-Clause", "dfb735646da984cb814b2aab18aef097d6e575950073bd82353f618e44014642"),
    ("BSD-2-Clause", "e90608a663ae638023eb95a6ae359f7b6b865e6237fa832c48500c4e1af035b9"),
    ("BSD-2-Clause", "e965bfe15cdcf092706da02c38cbf69ef02a729b58c76bb3557eec7c8c198a59"),
    ("BSD-2-Clause", "f9c0de945db946a0b06e8587a80b1b35b3f3e48a0f63cb64860eb4e433d32c7b"),
    ("BSD-3-Clause", "002ce4b8f1abc08327f935f87bf49584f7fc46fe8139a530cb4ce445fad613c6"),
    ("BSD-3-Clause", "02cbb88221e507a296bab4438d8c41fc55a45c1e486982b72971ef667bab440e"),
    ("BSD-3-Clause", "08736309e21ef4f4f04fe8d65d940170f6dead365ae956175f9f925b68835df1"),
    ("BSD-3-Clause", "0a3da30e7c439964059338cf631a7ca5318db70a0d82cd4bbe68144e75dc7688"),
    ("BSD-3-Clause", "0a67c8cf8e3cc7e532a8dd801f0f5897ae039f6289ad852aa229e1a2ac78d44a"),
    ("BSD-3-Clause", "0d9569accbee32dd3a420896d10f915d23071d627b49ca2f194661b3fa6aa139"),
    ("BSD-3-Clause", "0f4b00e6a717888a6af01dee97d72faf0f967aca58d345a5bc57dce7f9c4e399"),
    ("BSD-3-Clause", "16db4d4157a6fb102b89c3e41b88b39186551288dcb00bf376829446190230ef"),
    ("BSD-3-Clause", "17cee9607d52bb6198c43a77342f2bc0c845514239755c9bf1128943d2ad3783"),
    ("BSD-3-Clause", "198696ab639e3e61c31abf853f4c3d8c45d70c0d325d3349b1fa4647f35dd61a"),
    ("BSD-3-Clause", "22ed2427c5119ff085643fef4ca5364a866d1b046a92dfea977f412e4c67d146"),
    ("BSD-3-Clause", "26ceb0a978fd83d209cd22081d8636f2b41a1635ce06d61210c1380663ab7eca"),
    ("BSD-3-Clause", "2862502b8c0b9e2898bddc193550da25efbe12dcc633cf5c250c8acd75d2fcfc"),
    ("BSD-3-Clause", "326c317935b3409d9750fd4ad5326ce15c9b75d313b4baf2cb9ff54accf8d903"),
    ("BSD-3-Clause", "33aaf48a1bc03ef399d5b9c0fc83f491c4104c082f5234085e033b8a7d558c26"),
    ("BSD-3-Clause", "36fdcbfc8124635e7071d0ed2271bd9cac0cf975002801d50571c15dd8465554"),
    ("BSD-3-Clause", "4626de55caf0516a612eafcf9dcb71eb7c481c9075105bc72fc7685d6dbb42cd"),
    ("BSD-3-Clause", "4821dea41d36dcbae34a08602000341e5ff15c0e43987f6bb3ab7afd4322a67f"),
    ("BSD-3-Clause", "496a88fb77f7cf55994de8bd2b87ac0e9302e2dc1b11f567dd0447f8f0648ab1"),
    ("BSD-3-Clause", "4fec7901c0764f1c632da504aa28d5de5e7e5f0783c88d1e3fd21de4f97e315d"),
    ("BSD-3-Clause", "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa"),
    ("BSD-3-Clause", "69083549410d2f63af7724cabe9383c3da756a9875b71a13bdf06f218d41d7cc"),
    ("BSD-3-Clause", "6cc04e9acb959dcb8ea941e1b3496e5b6b4c29a24956436ce51b06213b15f11b"),
    ("BSD-3-Clause", "73a15ef51d0f74bce7fc4d1287b8d8a639c37581de7f63863957aea115dca7da"),
    ("BSD-3-Clause", "7668aff13b074ee8ff72fe4d1e7a5866b755b8fc00cd0239e4e80aec12f32127"),
    ("BSD-3-Clause", "7c16b387b2fd67aea7403110df9457eea9844b938eda62df5f98a56797001ccf"),
    ("BSD-3-Clause", "8078ca96ff592b24ba127e14c7f110f54057dcde2c6023deb34983ec3e23196c"),
    ("BSD-3-Clause", "88dc320725b8edce9f685c396626dfcf6856fe5d36b9df07867d6db7ab18318c"),
    ("BSD-3-Clause", "8b88fe5cd436a9a4d3e82af9529cfe2656ea0ed422a8a277c28394f0be169af5"),
    ("BSD-3-Clause", "8e06f3eb8c471515579052a428e5ab2d0777573b150dcfaf3c8b86b61989c907"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("BSD-3-Clause", "9b9ac51f5ca1f4f99ccf94a0770c77723a9b4a5eaf09e0de3f8c9ec65b1f396d"),
    ("BSD-3-Clause", "9f391d93a29a348c9dcaad53cfa5b22986e25a79bd1199aeaa924fa7c7498e6e"),
    ("BSD-3-Clause", "a56bc397db71dd0e38e476dd3b908e60e53634e2adafda1f1b6672e57be1ef0a"),
    ("BSD-3-Clause", "afc81ee99a150bf9ad976d1b4b3bae3ec8fb30e82c7f9ec18d0048b070d2ebc8"),
    ("BSD-3-Clause", "b019c75adb83e4ba417101dea8fd3bf3d0c51723b3c55854e913bb115b06fa57"),
    ("BSD-3-Clause", "b0b47238a1e6ab1d29d4fbb4de435cfd9d8ae32683649da50da189c31ff258ad"),
    ("BSD-3-Clause", "c0cc80e9013aae3515c93cc07d3f8ea7593e5f8fb785020bb21f9b21a99672ed"),
    ("BSD-3-Clause", "c19e45e4caf36d04a07032e4291ae19dfa1ba7a438b4d073c576d8271eb7dbd1"),
    ("BSD-3-Clause", "c31eefe033822132c2b5df919099c1384750a5d3354913e7396ee728cd8b7d6d"),
    ("BSD-3-Clause", "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15"),
    ("BSD-3-Clause", "d1ecc0a46c23dad7f9e13b19b877e5be7ec9d2b9bb05a2dfde2e47be83438590"),
    ("BSD-3-Clause", "d6257db4781e8531fee85c1cd8fe8adf06a6b7763ed73da1906a14d24925fc1d"),
    ("BSD-3-Clause", "d82109ca031904db888330a0ab8c8987685e71f8dbff7393792df6d32b4ae712"),
    ("BSD-3-Clause", "dc06088169d82bfb3bf20fa94566038849b41f0c772ebdf6cc13a92263873a65"),
    ("BSD-3-Clause", "dd9c572087f92a74232343008a70468eeee08d97112450db549eb0fb33a8d29e"),
    ("BSD-3-Clause", "e4d34334d1e19820930122c7816c18f12fa68d9d4a2a6d91f53e4567cdb02167"),
    ("BSD-3-Clause", "e60143686f94bbff438ca8d1ec28b93f48dab068c458d943110c425586e89f38"),
    ("BSD-3-Clause", "e74e439a0e4120562bce4a3f58259e0dcf2088a8442213bca7b0eda2832ad2eb"),
    ("BSD-3-Clause", "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af"),
    ("BSD-3-Clause", "fcfaca9856c9d06723391332be070f14157dc455699d40c8852a50b70f45fada"),
    ("BSD-3-Clause", "fd93c9a443ac94214588705916ba4e225a4dd20dd6e2cc33c1c4efee0b06d035"),
    ("BSD-3-Clause", "ff8f9f8d604b498788e48698201c62da514163db5b2e002c04d90575408fdaea"),
    ("CC0-1.0", "de4b88a2c819a4661af54f735069ed878216da8b4992b919b84afa18cfc0e54c"),
    ("GPL-1.0", "551b0b8462dc7e67a2ab5550e93f8cc48612fb93e6a59837e3c95d7610353c8f"),
    ("GPL-1.0", "7084d0106d209cde496701d21dfbe9bb489fd9bedf9778f3d718d2fe7377dfc7"),
    ("GPL-1.0", "74d0cd23803c9754c36f6ca0e1af411b418ed6b6564e757472bf0d870a1b5d1b"),
    ("GPL-1.0", "af30c0af27b90ec812acdb040f3dcc944a87cd893456690efe35063f39e3eeeb"),
    ("GPL-1.0", "cbe7331e93829cef2fc892c0c502d583fade2f252903c60120323b5d9d074d7f"),
    ("GPL-1.0", "ec8a6b7d70e9f225b63d3962ed5b4721373f5535d7b967a06722b0d621f6892a"),
    ("GPL-2.0", "1551b61aa183f987ecceedd8966ec1e9b2da3848f8862c2adedc0d82f41904ca"),
    ("GPL-2.0", "331b500eb3c5ee796906547305df82fff4a35b3aa03c1d3ea84d32078292b2e6"),
    ("GPL-2.0", "3d6c536f38203f43d4f882a96f62d08ef68247a99702d48f1c232a3250b408c1"),
    ("GPL-2.0", "6a4c1793053c857132d6ee663db7a0978f0e41de21b44c2dc6020c39d6c38bbb"),
    ("GPL-2.0", "c67cc53030ae25fe2e2f0143b59060eca5ad89da8d2beca1445641234d29fc88"),
    ("GPL-2.0", "e96e14de9c3b9dd8fb9b9c693f78237578ae05d8105b2ec72bbc79daaac48990"),
    ("GPL-3.0", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("GPL-3.0", "4868f466a3292b095d887ce2ca00548d3969efb48c33f6aced9a20c59f578c19"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "c50bb15c5f5e96b27d60ee792a7db1637c2e416eb98869999aab5af68506cd64"),
    ("GPL-3.0", "ce818a0d5cb7a9a9261f63641713dbb4ca4750284738a6c3f546d86d81a541d2"),
    ("ISC", "217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a"),
    ("ISC", "23651ce8a73abaa8fad9143faad3fca843b5de6baf345008f65c453ea5685fb1"),
    ("ISC", "40e6eb51c3b409d93549806b55b249c261dab149d19b56cc163624f39a08b1db"),
    ("ISC", "495def4cde05dd7818dcdf4c2a1b6ca483fba3011598f594c9e20faa2160690a"),
    ("ISC", "ed6e54e2ce452574e03afd562dd5f61916f2d7d1b427ec83eea72247409c6464"),
    ("ISC", "f172f90a892d869d5d840d5f4363218a9b21bdb1bd3925ba9c752d1660134fee"),
    ("ISC", "feb20b3710dba6fb7c1644da6efc7dab51b7cc08d454003531638e6ef56584a4"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "6e6982d8bb4468c5ce7a88e400f1540201513f39e8dd96e3607ee631b813c06f"),
    ("LGPL-2.0", "81ecf332fc652bb79c23397a1431c72d1f39f01ffdcec61843942283b44f4688"),
    ("LGPL-2.0", "aa06ce7f6e464e73e65ec0efa0bc575ef5bb7059ae0137ab610c2e57b32ca95c"),
    ("LGPL-2.1", "127c98b05c4e2851a27843fcf90984e5592c3841d8a6b7638dbcd00bcefe46dd"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "98d365a8217633113a201b5777e4d26ae0eb1d88079c5e39838162abe1f18db4"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-2.1", "e94f6c31379c2076fae91e236d6000ea55d918637fc8f30749aa0fe22a265c7f"),
    ("LGPL-3.0", "13980739d6423be0921994d8ce3ce547437735b0e6733161f70b19c962f194b7"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MIT", "0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c"),
    ("MIT", "2df4c2afd9b04c2f4d83966840cdb15ef41eed73534fc8d72dd0e579320439f6"),
    ("MIT", "35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164"),
    ("MIT", "52fc8ebdc3096d340da6d27296d33fd4eda745638fc87a662e5734326dfdd3fa"),
    ("MIT", "6ad3654379e72bbdf8478d5c90fb1e2525aba033fbe675e0ef2248aac67c0f6f"),
    ("MIT", "6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127"),
    ("MIT", "7c3366b22b9f0d6a198b2c29bd1c4b663b2d55eacbd066146e5476c4b8ff1ce4"),
    ("MIT", "8bb1131b2c47410aab10fbd4427b90f1881eecbbd6990c78c78afa666254b019"),
    ("MIT", "bf637265454fa1bb19e93b82695ec6f4ef7cfe2a7c742cf53ab79facb4d91c0c"),
    ("MPL-1.1", "2ccf6e5e40827e08f861c75b089d4ee0714ef61b39cfbbccc919708ff48113bd"),
    ("MPL-1.1", "95f7bf0a5019fac0d81741f29c91a72cc0a04b3dc781d770f55962d3a85497dc"),
    ("MPL-2.0", "13be81068349b1d5c488160003d6d65b960a5fc68ef8295b0f55983d3d56f70c"),
    ("MPL-2.0", "31311fe1c156de5f4ddced54b1aeb595a3017c64ab8abd033c5a64dfe32c179c"),
    ("Unlicense", "56b04c6c1008a5ed2f90c6a49c16a83bb7eaefb5ac6591adae0096cd07785d2c"),
    ("Unlicense", "9137ac0fab84d2bbd40d528074283e83bc514a40cae572819c6a647f087f1480"),
    ("Unlicense", "a85d2f83510bab5c6d6074ce1633e067a6eed07b6edc45d41ae264a0ea78af76"),
    ("Unlicense", "d5c59598465a8119e960a42b8f463f542ca3466b187c4d7597c853a682fd82c6"),
    ("Unlicense", "d7ef23de23a66be0e3fdecee1f6bdf9f3d78ae8b5f45a1085c6bfae0eab283bd"),
    ("Unlicense", "ddfc3bec6a20fc8dd9480d13215af04f8b77e401ef43d884456b26c471797458"),
    ("Unlicense", "e6e60d2037efe58841d698b341a609d8a738effceaadb12ac721e54f8e0bf7db"),
    ("Unlicense", "fd1b07be5f4f94926b6ea4df3943b05ab90c1a1f3b1a3d574ae7ab58bca58fff"),
    ("Zlib", "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7"),
    ("Zlib", "719fe9b2b2742d50a5474e04f8e03642a04622355798993d9af8d2f7a1cd47e8"),
    ("Zlib", "86b073818d5354754db821924ecea22fe1926896de52322770f0f199e67ceb72"),
    ("Zlib", "99618428d879198d4ae824db7ad07a9d0f9214f15429de52839cbe667713f21a"),
    ("Zlib", "c45c1816fdb6988a579a27d4dc86cbfb4640b35f380134a96b714de8d663bf69"),
    ("Zlib", "e8b4b40ce77fe1c6b396712780f759e806aa4252d6177655c74c2f9e80b083db"),
    ("Zlib", "ee37bc3ccba61ff28a10c05f28bdabf7466db400a75d9a1890fb865cda23e145"),
]
